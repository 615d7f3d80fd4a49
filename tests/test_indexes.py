"""Stored indexes and layouts against plain search."""

import datetime as dt
import math
import pathlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetra.functions.search import register_vector_search
from telemetra.operators import joins, layout, retrieval, stored, textindex, vectorindex
from telemetra.session import scratch_path, shared_root

UTC = dt.timezone.utc


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def texts(spark):
    generator = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(generator.choices(words, [1 / (k + 1) for k in range(200)], k=generator.randrange(5, 40))))
            for i in range(400)]
    rows += [(400, None), (401, ""), (402, "Ünïque W1, w1; w2!"), (403, "w5 " * 300)]
    return rows


def index_of(spark, rows, parts=3):
    index = textindex.TextIndex(spark, scratch_path(spark, "index"))
    frame = spark.createDataFrame(rows, "id long, body string")
    for part in range(parts):
        index.add(frame.where(F.col("id") % parts == part), "id", "body")
    return index, frame


def test_text_index_equals_a_full_scan(spark, texts, monkeypatch):
    monkeypatch.setattr(textindex, "SPAN", 16)
    monkeypatch.setattr(textindex, "PROBED", 2)
    index, frame = index_of(spark, texts)
    for question in ("w150 w3 w77", "W1 ünïque", "w0 w1 w2 w3 w4 w199", "nothing of that", ""):
        got = [(r.key, round(r.similarity, 9)) for r in index.search(question, 7).collect()]
        want = [(r.id, round(r.similarity, 9)) for r in
                retrieval.nearest_texts(frame, "id", "body", question, 7).collect()]
        assert got == want, question
    asked = textindex._Search(index, "w150 w3 w77", 3)
    assert asked.open_spans().count() < asked.bounds.count()


def test_text_index_reads_only_its_terms_folders(spark, texts):
    index, _ = index_of(spark, texts, parts=1)
    text = plan(index.postings(["w150"], [1]))
    assert re.search(r"PartitionFilters: \[.*folder#\d+ = \d+|folder#\d+ IN", text)
    assert "EqualTo(term,w150)" in text or "In(term" in text
    folders = index.postings(["w150"], [1]).select(F.input_file_name()).distinct().collect()
    assert len({re.search(r"folder=(\d+)", r[0])[1] for r in folders}) == 1


def test_text_index_stores_postings_and_keys_only(spark, texts):
    scratch = pathlib.Path(shared_root(spark), "telemetra")
    before = {p.name for p in scratch.glob("terms-*")}
    index, frame = index_of(spark, texts, parts=1)
    assert {p.name for p in scratch.glob("terms-*")} == before
    postings = spark.read.parquet(f"{index.path}/postings")
    assert not any(f.dataType.simpleString().startswith("array<struct") for f in postings.schema)
    words = sum(len(re.findall(r"\w+", body or "")) for _, body in texts)
    assert index._segments() == [(1, len(texts), words)]
    assert postings.agg(F.sum(F.aggregate("counts", F.lit(0), lambda a, c: a + c))).first()[0] == words


def test_text_index_takes_texts_without_terms_and_equal_keys(spark):
    index, _ = index_of(spark, [(1, None), (2, "")], parts=1)
    assert [r.key for r in index.search("a", 5).collect()] == [1, 2]
    index = textindex.TextIndex(spark, scratch_path(spark, "index"))
    index.add(spark.createDataFrame(
        [(1, "a b"), (1, "b a"), (None, "a a"), (3, "c")], "id long, body string"), "id", "body")
    hits = spark.read.parquet(f"{index.path}/postings").where("term = 'a'").select(
        F.explode(F.arrays_zip("keys", "counts", "lengths")).alias("h")).select("h.*").collect()
    assert {tuple(h) for h in hits} == {(1, 2, 2), (None, 2, 2)}


def test_unfinished_segment_does_not_count(spark, texts):
    index, _ = index_of(spark, texts[:50], parts=1)
    spark.createDataFrame([(9, "w0 " * 50)], "key long, term string").write.parquet(f"{index.path}/keys/segment=2")
    assert 9 in {r.key for r in index.search("zzz", 60).collect()} and index.search("zzz", 60).count() == 50


def test_vector_index_recall_by_size_and_changes(spark):
    generator = np.random.default_rng(4)
    centres = generator.normal(size=(12, 24))
    rows = [(i, [float(x) for x in centres[i % 12] + generator.normal(size=24) * 0.6]) for i in range(900)]
    rows += [(900, None), (901, [0.0] * 24), (902, [])]
    frame = spark.createDataFrame(rows, "id long, v array<double>").repartition(4)
    index = vectorindex.VectorIndex(spark, scratch_path(spark, "vectors"))
    index.create(frame.where("id < 600"), "id", "v")
    index.add(frame.where("id >= 600"), "id", "v")
    asked = {q: rows[q][1] for q in range(0, 900, 23)}
    got = {(r.question_id, r.key): r.similarity for r in index.search(asked, 5).collect()}
    matrix = np.array([r[1] for r in rows[:900]])
    matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
    hits = total = 0
    for q in asked:
        alike = matrix @ matrix[q]
        best = np.argsort(-alike, kind="stable")[:5]
        total += 5
        hits += sum((q, int(b)) in got for b in best)
        for (p, key), similarity in got.items():
            if p == q:
                assert similarity == pytest.approx(alike[key], abs=1e-9)
    assert hits / total >= 0.9
    assert len(index.codebook().cells_of(matrix[:1])[0]) < len(index.codebook().centres)
    index.remove(spark.createDataFrame([(0,), (23,)], "id long"))
    index.add(spark.createDataFrame([(23, rows[46][1])], "id long, v array<double>"), "id", "v")
    found = {r.question_id: r for r in index.search({0: rows[0][1], 46: rows[46][1]}, 1).collect()}
    assert found[0].key != 0 and found[46].key == 23 and found[46].similarity == pytest.approx(1.0)
    with pytest.raises(ValueError):
        index.search({}, 1)


def test_table_function_over_a_table(spark):
    generator = np.random.default_rng(6)
    rows = [(i, [float(x) for x in generator.normal(size=6)]) for i in range(80)] + [(80, None), (81, [0.0] * 6)]
    spark.createDataFrame(rows, "k long, v array<double>").repartition(3).createOrReplaceTempView("search_test")
    name = register_vector_search(spark, "search_test_fn")
    question = ", ".join(f"{x!r}D" for x in rows[7][1])
    got = spark.sql(f"""SELECT item, similarity FROM {name}(TABLE(SELECT k, v, k % 4 AS s FROM search_test)
        PARTITION BY (s), array(array({question})), 3) ORDER BY similarity DESC LIMIT 3""").collect()
    plain = sorted(((np.dot(v, rows[7][1]) / np.linalg.norm(v) / np.linalg.norm(rows[7][1]), k)
                    for k, v in rows[:80]), reverse=True)[:3]
    assert [r.item for r in got] == [k for _, k in plain]
    assert [r.similarity for r in got] == pytest.approx([s for s, _ in plain])


def test_curve_skips_files_for_either_column(spark):
    generator = random.Random(3)
    start = dt.datetime(2024, 1, 1, tzinfo=UTC)
    rows = [(generator.randrange(40) if i % 3 else 7, start + dt.timedelta(minutes=generator.randrange(40_000)), i)
            for i in range(6000)] + [(None, start, -1), (5, None, -2)]
    frame = spark.createDataFrame(rows, "asset int, at timestamp, n int")
    path = scratch_path(spark, "curve")
    layout.write_along_curve(frame, path, ["asset", "at"], 36)
    files = spark.read.parquet(f"{path}/files")
    assert files.agg(F.sum("row_count")).first()[0] == len(rows)
    sizes = [r.row_count for r in files.collect()]
    assert max(sizes) < 3 * len(rows) / len(sizes)  # a hot asset is cut over several files
    day = start + dt.timedelta(days=10)
    for wanted, keep in (
        ({"asset": (20, 20)}, lambda r: r[0] == 20),
        ({"at": (day, day + dt.timedelta(hours=6))}, lambda r: r[1] and day <= r[1] <= day + dt.timedelta(hours=6)),
        ({"asset": (3, 9), "at": (day, day)}, lambda r: r[0] is not None and 3 <= r[0] <= 9 and r[1] == day),
        ({"asset": (99, 99)}, lambda r: False),
    ):
        assert len(layout.files_for(spark, path, wanted)) <= len(sizes) / 2
        assert sorted(r.n for r in layout.read_slice(spark, path, wanted).collect()) == sorted(
            r[2] for r in rows if keep(r))


def test_checksums_find_changed_ranges_only(spark):
    base = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    edges = layout.key_edges(base, "k")
    assert len(edges) > 3000
    other = base.where("k <> 777").withColumn("v", F.when(F.col("k") == 15_000, -1).otherwise(F.col("v"))).unionByName(
        spark.createDataFrame([(50_000, 1)], "k long, v long"))
    found = layout.unequal_ranges(*(layout.checksums(t, "k", edges) for t in (base, other)))
    assert len(found) == 3
    text = plan(layout.rows_in_ranges(base, "k", edges, found))
    assert "Filter" in text or "Range" in text
    few = sorted(r.k for r in layout.rows_in_ranges(other, "k", edges, found).collect())
    assert len(few) < 40 and 15_000 in few and 50_000 in few
    assert layout.unequal_ranges(*(layout.checksums(t, "k", edges) for t in (base, base))) == []
    many = list(range(0, len(edges) + 1, 2))
    rows = layout.rows_in_ranges(base, "k", edges, many).count()
    assert rows == sum(r.n for r in layout.checksums(base, "k", edges).where("level = 3 AND node % 2 = 0").collect())


def test_bucketed_join_has_no_exchange(spark):
    names = []
    frames = {
        "s": spark.createDataFrame([(i % 9, float(i)) for i in range(90)], "asset_id long, x double"),
        "a": spark.createDataFrame([(i, f"m{i}") for i in range(9)], "asset_id long, model string"),
        "i": spark.createDataFrame([(i, "ok", 0) for i in range(0, 9, 2)], "asset_id long, abnormal_channel string, start_time int"),
    }
    for label, df in frames.items():
        names.append(f"bucketed_test_{label}")
        spark.sql(f"DROP TABLE IF EXISTS {names[-1]}")
        joins.write_bucketed(df, names[-1], scratch_path(spark, f"b{label}"), buckets=4)
    joined = joins.label_by_key_bucketed(spark, *names)
    text = plan(joined)
    assert "Exchange" not in text and text.count("SortMergeJoin") == 2
    plainly = joins.label_by_key(*frames.values())
    assert sorted(map(tuple, joined.select(*plainly.columns).collect())) == sorted(map(tuple, plainly.collect()))


def test_numbers_go_on_after_a_load_that_died(spark, monkeypatch):
    table = stored.StoredTable(spark, scratch_path(spark, "ids"))
    empty = spark.createDataFrame([], "k long, row_id long")
    table.create(empty, ["k"], stored.hashed(["k"], 4))
    table.append_numbered(spark.range(5).withColumnRenamed("id", "k"), [F.col("k")], "row_id")
    commit = table._commit
    monkeypatch.setattr(table, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        table.append_numbered(spark.range(10, 13).withColumnRenamed("id", "k"), [F.col("k")], "row_id")
    monkeypatch.setattr(table, "_commit", commit)
    table.append_numbered(spark.range(20, 24).withColumnRenamed("id", "k"), [F.col("k")], "row_id")
    assert sorted(map(tuple, table.read().collect())) == [
        *((k, k + 1) for k in range(5)), *((k, k - 14) for k in range(20, 24))]


def test_only_levels_in_use_are_looked_up(spark):
    day = dt.datetime(2024, 1, 1, tzinfo=UTC)
    stats = spark.createDataFrame([(1, day + dt.timedelta(hours=h)) for h in range(48)], "asset_id int, bucket timestamp")
    base = int(day.timestamp())
    spans = spark.createDataFrame([(1, base, base + 7200), (1, base, base + 10 * 86_400)], "asset_id int, start_time long, end_time long")
    got = joins.label_by_interval(stats, spans)
    assert got.count() == 1 + 47
    levels = re.findall(r"_level", plan(joins.label_by_interval(stats, spans)))
    assert levels and "262144" not in plan(joins.label_by_interval(stats, spans))
    assert math.isclose(joins.row_bytes(spans.schema), 40)
