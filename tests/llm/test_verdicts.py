"""Verdicts and balances against plain forms."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import DOCS, some_docs
from telemetra.llm import quality, sharding


def plain_differencing(sizes, k):
    """Sums of the parts, by joining the two partial partitions of largest spread."""
    parts = [sorted([s] + [0] * (k - 1), reverse=True) for s in sizes]
    alive = set(range(len(parts)))
    while len(alive) > 1:
        a, b = sorted(alive, key=lambda i: (parts[i][-1] - parts[i][0], i))[:2]
        parts.append(sorted((x + y for x, y in zip(parts[a], reversed(parts[b]))), reverse=True))
        alive = alive - {a, b} | {len(parts) - 1}
    return parts[alive.pop()]


@pytest.mark.parametrize("k", [2, 5, 40])
def test_differencing_equals_the_plain_form(k):
    random = np.random.default_rng(k)
    sizes = np.concatenate([random.geometric(0.01, 120), [5000, 5000, 1]])
    parts = np.zeros((len(sizes), k), np.int64)
    parts[:, 0] = sizes
    places, top = sharding.difference(parts)
    assert top.tolist() == plain_differencing(sizes.tolist(), k)
    assert np.bincount(places[:, 0], sizes, k).tolist() == top.tolist()


def test_shards_of_units_are_as_even_as_of_one(spark, monkeypatch):
    random = np.random.default_rng(1)
    rows = [(i, "x" * int(n)) for i, n in enumerate(random.geometric(0.005, 3000))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    spreads = []
    for unit in (20_000, 100):
        monkeypatch.setattr(sharding, "UNIT", unit)
        sums = sharding.shard(frame).groupBy("shard").agg(F.sum("size").alias("s")).collect()
        spreads.append(max(r.s for r in sums) - min(r.s for r in sums))
    heaviest = max(len(t) for _, t in rows) + 16
    assert spreads[0] <= 100 and spreads[1] <= heaviest


def plain_verdicts(rows):
    """``kept`` of measured rows, with exact quartiles."""
    def group(r):
        return r.lang.lower() if r.lang and re.fullmatch("[a-z]{2}", r.lang.lower()) else f"script:{r.script or 'none'}"

    def values(r):
        return r.word_chars / r.n_tokens, r.n_fallback / r.n_tokens, r.window_entropy

    def quartiles(members):
        out = []
        for v in zip(*map(values, members)):
            v = sorted(v)
            low, mid, high = (v[max(0, math.ceil(p * len(v)) - 1)] for p in (0.25, 0.5, 0.75))
            out.append((mid, (high - low) / 1.349))
        return out

    good = [r for r in rows if not r.base_failed]
    def members(band):
        return [r for r in good if band in (group(r), f"script:{r.script or 'none'}", "")]

    verdicts = []
    for r in rows:
        if r.base_failed:
            verdicts.append(False)
            continue
        band = group(r)
        own = members(band)
        scripts = [m.script or "none" for m in own]
        main = min(s for s in scripts if scripts.count(s) == max(map(scripts.count, scripts)))
        parent = "" if main == "none" else band if band.startswith("script:") else f"script:{main}"
        weight = len(own) / (len(own) + quality.SHRINK)
        (mid_f, dev_f), (mid_b, dev_b), (mid_e, dev_e) = (
            tuple(weight * x + (1 - weight) * y for x, y in zip(a, b))
            for a, b in zip(quartiles(own), quartiles(members(parent))))
        widen = 2 - weight
        fertility, fallback, entropy = values(r)
        outside = (
            abs(fertility - mid_f) > widen * max(quality.FERTILITY_WIDTH * dev_f, quality.FERTILITY_SHARE * mid_f)
            or fallback > mid_b + widen * max(quality.FERTILITY_WIDTH * dev_b, quality.FALLBACK_SLACK)
            or entropy < mid_e - widen * max(quality.ENTROPY_WIDTH * dev_e, quality.ENTROPY_SHARE * mid_e))
        verdicts.append(not outside)
    return verdicts


def test_quality_verdicts_equal_the_plain_form(spark):
    random = np.random.default_rng(2)
    words = ["the", "house", "garden", "water", "morning", "people", "story", "window", "evening"]
    rows = [(i, " ".join(random.choice(words, 40)), "en", "a", 0, "k", "d") for i in range(120)]
    rows += [(200 + i, " ".join(chr(0x1F300 + int(c)) * 2 for c in random.integers(0, 200, 40)), ["en", None][i % 2], "a", 0, "k", "d")
             for i in range(6)]
    rows += [(300 + i, " ".join("".join(random.choice(list("abcdef0123456789+/"), 30)) for _ in range(25)), "en", "a", 0, "k", "d")
             for i in range(4)]
    rows += [(400, " ".join(f"το{w}σπίτι είναι" for w in words * 4), "el", "a", 0, "k", "d")]
    rows += [(r[0] + 1000 if r[0] is not None else None, *r[1:]) for r in some_docs()]
    got = quality.rate(spark.createDataFrame(rows, DOCS)).collect()
    want = plain_verdicts(got)
    assert [r.kept for r in got] == want
    assert {r.doc_id for r in got if not r.kept and not r.base_failed} >= {200, 202, 204}
