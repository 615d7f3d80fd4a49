"""Document scores of a gated recurrent language model over words.

The model is a numpy GRU with a class-factored softmax over frequent words, hashed symbols of rare
words and one symbol for the end. A rare word's symbol comes from its last letters, and its own
share of that symbol from corpus counts, so each text gets a proper probability whatever words it
has. The vocabulary grows with the corpus by a power of its tokens; classes follow frequency, so
that the classes met often are small and the cost of a token grows much more slowly.
"""

from __future__ import annotations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from telemetra.llm import text as tx
from telemetra.llm.frames import arrow_map
from telemetra.session import materialize, spread

END = 0
HIDDEN = 16
VOCABULARY, POWER = 6, 0.4  # a corpus of n tokens has VOCABULARY * n**POWER words of its own
RARE_SHARE = 8  # and a symbol of rare words for each so many of those, LEAST_RARE at least
LEAST_RARE = 64
ENDING = 3  # bytes by which a rare word is given its symbol
PIECE = 64  # weights that are updated and averaged together
SLICE = 1024  # pieces that one row carries from a trainer to the averages
FAN = 64  # trainers whose weights one task adds up
WINDOW = 24  # steps that errors are carried back
SEGMENT = 40 * WINDOW  # training cuts longer documents, scoring does not
LANES = 512  # documents read side by side
LANE_TOKENS = 2048  # of a trainer, from which it takes one more lane
STRIP = 4096  # states that meet all classes at a time
READ_OUT = 16_384  # states of scored texts that are read out together
GROUP = 4_000_000  # tokens scored side by side, so that long documents run beside others
ROUNDS = 2  # parts of the training texts after which the trainers' weights are averaged
TRAINER_TOKENS = 1 << 21  # trainers number 4 times the root of the tokens divided by this
LOOKUP_WORDS = 500_000  # words whose counts every task holds, if not more are in the vocabulary
LEVELS = 16  # of counts for each doubling, when words are divided by count
FOLDS, HELD_FOLD = 5, 1
RATE = 0.02


def held_out():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_FOLD


def groups(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """An order that sorts the numbers, where each distinct one begins in it, and how often each
    occurs. Not stable, which numpy's vectorised sort of 64-bit numbers is not either."""
    order = np.argsort(numbers)
    inside = numbers.take(order)
    new = np.ones(len(inside), bool)
    new[1:] = inside[1:] != inside[:-1]
    begin = np.flatnonzero(new)
    return order, begin, np.diff(begin, append=len(inside))


def word_counts(docs: DataFrame) -> DataFrame:
    """``word`` (64-bit hash), ``ending`` (hash of its last letters), ``n`` over all words of the
    rows, merged inside tasks first."""
    def merge(parts):
        hashes, endings, counts = (np.concatenate(side) for side in zip(*parts))
        order, begin, _ = groups(hashes)
        first = order.take(begin)
        return hashes.take(first), endings.take(first), np.add.reduceat(counts.take(order), begin)

    def rows(values, endings, counts):
        return {"word": values.view(np.int64), "ending": endings, "n": counts}

    def run(batches):
        parts, held = [], 0
        for _, block in tx.blocks(batches, fold=True):
            hashes = block.hashes()
            order, begin, counts = groups(hashes)
            first = order.take(begin)
            if len(first):
                parts.append((hashes.take(first), endings(block, first), counts))
                held += len(first)
            if held > 1_500_000:
                parts = [merge(parts)]
                held = 2 * len(parts[0][0])
                if len(parts[0][0]) > 750_000:
                    yield rows(*parts[0])
                    parts, held = [], 0
        if parts:
            yield rows(*merge(parts))

    return arrow_map(docs.select("text"), run, "word long, ending int, n long").groupBy("word").agg(
        F.first("ending").alias("ending"), F.sum("n").alias("n"))


def endings(block: tx.Block, words: np.ndarray | slice = slice(None)) -> np.ndarray:
    """Non-negative hashes of the last bytes of all words, or of those with these numbers."""
    starts, ends = block.starts[words], block.ends[words]
    tails = block.runs.between(np.maximum(starts, ends - ENDING), ends)
    return (tails >> np.uint64(33)).astype(np.int32)


def class_cuts(counts: np.ndarray) -> np.ndarray:
    """Bounds of the classes over symbols in order of falling count.

    Each class holds the same sum of roots of counts, which makes the sizes that are met on
    average as small as so many classes can.
    """
    size = len(counts)
    classes = max(2, round(2 * (size / np.log(size + 2)) ** 0.5))
    weight = np.cumsum((counts + 0.5) ** 0.5)
    cuts = np.searchsorted(weight, weight[-1] * np.arange(1, classes) / classes)
    return np.unique(np.concatenate([[0], cuts, [size]]))


class Model:
    """Weights of the network, all in one vector so that they can be averaged.

    ``cuts`` are the bounds of the classes over symbol numbers.
    """

    def __init__(self, cuts: np.ndarray, width: int = HIDDEN, vector=None, seed: int = 5):
        h, symbols, classes = width, int(cuts[-1]), len(cuts) - 1
        self.cuts, self.width, self.n_classes = cuts, width, classes
        self.class_of = np.repeat(np.arange(classes), np.diff(cuts))
        shapes = {
            "enter": (h, 3 * h), "recur": (h, 3 * h), "bias": (3 * h,),
            "classes": (h, classes), "class_bias": (classes,), "word_bias": (symbols,),
            "inputs": (symbols, h), "words": (symbols, h),
        }
        sizes = np.cumsum([0, *(int(np.prod(s)) for s in shapes.values())])
        fresh = vector is None
        if fresh:
            size = -(-int(sizes[-1]) // PIECE) * PIECE
            vector = np.random.default_rng(seed).standard_normal(size, np.float32) * np.float32(0.08)
        self.vector = vector
        for (name, shape), begin, end in zip(shapes.items(), sizes[:-1], sizes[1:]):
            setattr(self, name, vector[begin:end].reshape(shape))
        if fresh:
            self.enter *= np.float32(1 / (0.08 * h**0.5))
            self.bias[:] = 0

    def start_from(self, counts: np.ndarray) -> None:
        """Output biases that give each symbol its share of the training words."""
        share = counts + 0.5
        whole = np.add.reduceat(share, self.cuts[:-1])
        self.class_bias[:] = np.log(whole / share.sum())
        self.word_bias[:] = np.log(share / whole[self.class_of])

    def like(self, vector: np.ndarray) -> "Model":
        return Model(self.cuts, self.width, vector)


def begins(fresh: np.ndarray) -> list[np.ndarray]:
    """Of each step the lanes in which a document begins."""
    step, lane = np.nonzero(fresh)
    return np.split(lane, np.searchsorted(step, np.arange(1, len(fresh))))


def forward(model: Model, symbols: np.ndarray, fresh: np.ndarray, state: np.ndarray, keep: bool = True):
    """Hidden states before each symbol; ``symbols`` and ``fresh`` are steps x lanes.

    The state is set to zero where a new document begins. Returns what training needs, if it is
    to be kept. Inside, lanes are the last axis, so that each gate lies in one piece.
    """
    h, kept = model.width, []
    hidden = np.empty((len(symbols), h, symbols.shape[1]), np.float32)
    # gates take the exponential of the negative
    sign = np.repeat(np.float32([-1, 1]), [2 * h, h])
    driven = np.matmul((model.enter * sign).T, model.inputs.take(symbols, axis=0).transpose(0, 2, 1))
    driven += (model.bias * sign)[:, None]
    gating, recalling = -model.recur[:, : 2 * h].T, np.ascontiguousarray(model.recur[:, 2 * h:].T)
    state = state.T.copy()
    for t, begun in enumerate(begins(fresh)):
        if len(begun):
            state[:, begun] = 0
        hidden[t] = state
        gates = gating @ state
        gates += driven[t, : 2 * h]
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        inner = gates[:h] * state
        new = recalling @ inner
        new += driven[t, 2 * h:]
        np.tanh(new, out=new)
        if keep:
            kept.append((gates, inner, new, state))
        after = new - state
        after *= gates[h:]
        after += state
        state = after
    return np.ascontiguousarray(hidden.transpose(0, 2, 1)), kept, state.T


def short(numbers: np.ndarray, end: int) -> np.ndarray:
    """Numbers below ``end`` in two bytes if they fit, which numpy sorts in linear time."""
    return numbers.astype(np.uint16) if end <= 1 << 16 else numbers


def shares(logits: np.ndarray, tame: bool) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials and their sums by row; logits that may be large are held down."""
    if not tame:
        np.minimum(logits, 80, out=logits)
    power = np.exp(logits, out=logits)
    return power, power @ np.ones(logits.shape[1], np.float32)


def stays_tame(model: Model) -> bool:
    """Whether no logit can pass 80: states lie in (-1, 1)."""
    weights = max(float(np.abs(w).max(initial=0)) for w in (model.words, model.classes))
    biases = max(float(np.abs(w).max(initial=0)) for w in (model.word_bias, model.class_bias))
    return weights * model.width + biases < 80


def choice(states, weights, chosen, tame: bool, learn: bool, plain: np.ndarray | None = None):
    """Log-probability of the chosen row of ``weights`` for each state.

    Both end in one more column: ones of the states, biases of the weights; ``plain`` are the
    weights without it, if they lie in one piece. For learning also the gradient of the weights
    and the error of the states; only these are divided by the sums of exponentials, not every
    exponential.
    """
    logits = states @ weights.T
    flat = logits.reshape(-1)
    at = np.arange(0, len(flat), len(weights))
    at += chosen
    logp = flat.take(at)
    power, total = shares(logits, tame)
    logp -= np.log(total)
    if not learn:
        return logp, None, None
    flat[at] -= total
    total = np.reciprocal(total)[:, None]
    error = power @ (weights[:, :-1] if plain is None else plain)
    error *= total
    return logp, power.T @ (states * total), error


def output(model: Model, hidden: np.ndarray, symbols: np.ndarray, grad: Model | None = None):
    """Log-probability of each symbol given the state before it, and the error of the states."""
    # in order of class, so that each class is one slice
    kind = model.class_of.take(symbols)
    order = np.argsort(short(kind, model.n_classes), kind="stable")
    symbols, kind = symbols.take(order), kind.take(order)
    hidden = np.column_stack([hidden.take(order, axis=0), np.ones(len(hidden), np.float32)])
    cuts = np.searchsorted(kind, np.arange(model.n_classes + 1)).tolist()
    tame, learn = stays_tame(model), grad is not None
    logp = np.empty(len(symbols), np.float32)
    error = np.empty((len(symbols), model.width), np.float32) if learn else None
    classes = np.column_stack([model.classes.T, model.class_bias])
    for at in range(0, len(symbols), STRIP):  # strips stay in the processor's cache
        part = slice(at, at + STRIP)
        logp[part], change, errors = choice(hidden[part], classes, kind[part], tame, learn)
        if learn:
            grad.classes += change[:, :-1].T
            grad.class_bias += change[:, -1]
            error[part] = errors
    bounds = model.cuts.tolist()
    inside = symbols - model.cuts.take(kind)
    words = np.column_stack([model.words, model.word_bias])
    for c in range(model.n_classes):
        begin, end = bounds[c], bounds[c + 1]
        if cuts[c] == cuts[c + 1] or end - begin == 1:
            continue  # a class of one symbol leaves nothing to choose
        own = slice(cuts[c], cuts[c + 1])
        share, change, errors = choice(
            hidden[own], words[begin:end], inside[own], tame, learn, model.words[begin:end])
        logp[own] += share
        if learn:
            grad.words[begin:end] += change[:, :-1]
            grad.word_bias[begin:end] += change[:, -1]
            error[own] += errors
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return logp.take(back), error.take(back, axis=0) if learn else None


def backward(model: Model, grad: Model, symbols, fresh, hidden, kept, errors) -> None:
    """Errors carried back through the steps of one window."""
    h = model.width
    errors = np.ascontiguousarray(errors.transpose(0, 2, 1))
    later = np.zeros_like(errors[0])
    flows = np.empty((len(symbols), 3 * h, symbols.shape[1]), np.float32)
    gating, recalling = np.ascontiguousarray(model.recur[:, : 2 * h]), np.ascontiguousarray(model.recur[:, 2 * h:])
    begun = begins(fresh)
    for t in range(len(symbols) - 1, -1, -1):
        gates, inner, new, state = kept[t]
        reset, update = gates[:h], gates[h:]
        shut = 1 - gates
        moved = later * update
        flow = flows[t]
        d_new = flow[2 * h:]
        np.multiply(new, new, out=d_new)
        np.subtract(1, d_new, out=d_new)
        d_new *= moved
        d_inner = recalling @ d_new
        np.multiply(d_inner, inner, out=flow[:h])
        np.subtract(new, state, out=flow[h: 2 * h])
        flow[h: 2 * h] *= moved
        flow[: 2 * h] *= shut
        later -= moved
        d_inner *= reset
        later += d_inner
        later += gating @ flow[: 2 * h]
        later += errors[t]
        if len(begun[t]):
            later[:, begun[t]] = 0
    flat = np.ascontiguousarray(flows.transpose(0, 2, 1)).reshape(-1, 3 * h)
    grad.recur[:, : 2 * h] += hidden.reshape(-1, h).T @ flat[:, : 2 * h]
    grad.recur[:, 2 * h:] += np.concatenate([inner for _, inner, _, _ in kept], axis=1) @ flat[:, 2 * h:]
    grad.bias += flat.sum(axis=0)
    grad.enter += model.inputs.take(symbols.ravel(), axis=0).T @ flat
    order = np.argsort(short(symbols.ravel(), len(model.inputs)), kind="stable")
    inside = symbols.ravel().take(order)
    at = np.flatnonzero(np.concatenate([[True], inside[1:] != inside[:-1]]))
    grad.inputs[inside[at]] += np.add.reduceat((flat @ model.enter.T).take(order, axis=0), at, axis=0)


class Adam:
    """Adam over those pieces of the weights that a window touches, so that a large vocabulary
    costs a window only the words and classes that occur in it."""

    def __init__(self, size: int):
        self.first, self.second = np.zeros((2, size // PIECE, PIECE), np.float32)
        self.steps = np.zeros(size // PIECE, np.int64)
        self.gradient = np.zeros(size, np.float32)  # zero between updates
        self.step = 0

    def update(self, vector: np.ndarray, share: float) -> None:
        """One step along the collected gradient times ``share``, which is cleared."""
        self.step += 1
        pieces = self.gradient.reshape(-1, PIECE)
        # by their bits, as sums that begin at zero never give the other zero
        at = np.flatnonzero(np.bitwise_or.reduce(pieces.view(np.uint64), axis=1))
        parts = [at[k: k + SLICE] for k in range(0, len(at), SLICE)]  # no copy of all weights
        # pieces side by side are changed where they are
        parts = [slice(k[0], k[-1] + 1) if k[-1] - k[0] == len(k) - 1 else k for k in parts]
        norm = share * sum(float((pieces[k] ** 2).sum()) for k in parts) ** 0.5
        share *= min(1.0, 1.0 / max(norm, 1e-12))
        rate = RATE / (1 + self.step / 300) ** 0.5
        weights = vector.reshape(-1, PIECE)
        self.steps[at] += 1
        for k in parts:
            gradient = pieces[k] * np.float32(share)
            pieces[k] = 0
            first, second = self.first[k], self.second[k]
            first *= np.float32(0.9)
            change = np.float32(0.1) * gradient
            first += change
            second *= np.float32(0.99)
            np.multiply(np.float32(0.01), gradient, out=change)
            change *= gradient
            second += change
            self.first[k], self.second[k] = first, second
            steps = self.steps[k][:, None]
            np.divide(first, (1 - 0.9**steps).astype(np.float32), out=change)
            change *= np.float32(rate)
            np.divide(second, (1 - 0.99**steps).astype(np.float32), out=gradient)
            np.sqrt(gradient, out=gradient)
            gradient += np.float32(1e-8)
            change /= gradient
            weights[k] -= change


def lanes(lengths: np.ndarray) -> list[list[int]]:
    """Documents dealt to lanes of similar length, the longest first."""
    fair = int(lengths.sum()) // LANE_TOKENS + 8
    count = min(LANES, len(lengths), fair)
    found: list[list[int]] = [[] for _ in range(count)]
    order = np.argsort(-lengths, kind="stable")
    # back and forth over the lanes evens them out
    for i, doc in enumerate(order.tolist()):
        turn, at = divmod(i, count)
        found[at if turn % 2 == 0 else count - 1 - at].append(doc)
    return sorted(found, key=lambda docs: -int(lengths[docs].sum()))


def windows(symbols: np.ndarray, begin: np.ndarray):
    """Steps x lanes of symbols, first-symbol marks and document numbers, window by window.

    Lanes are in order of length, so the lanes still running are always the first ones. A
    document number of -1 stands behind the end of a lane.
    """
    lengths = np.diff(begin)
    rows = lanes(lengths)
    order = np.concatenate(rows).astype(np.int64)
    # the documents in order of lanes, one after the other
    ends = np.cumsum(lengths[order])
    owner = np.repeat(order.astype(np.int32), lengths[order])
    place = np.arange(len(owner)) - np.repeat(ends - lengths[order], lengths[order])
    flat = symbols[begin[:-1][owner] + place]
    fresh = place == 0
    totals = np.array([int(lengths[docs].sum()) for docs in rows])
    starts = np.cumsum(totals) - totals
    for at in range(0, int(totals[0]), WINDOW):
        live = int(np.searchsorted(-totals, -at, "left"))
        step = np.arange(at, min(int(totals[0]), at + WINDOW))[:, None]
        where = starts[:live] + step
        if step[-1, 0] < totals[live - 1]:  # no lane ends before the window does
            yield flat.take(where).astype(np.int64), fresh.take(where), owner.take(where)
            continue
        real = step < totals[:live]
        where = np.where(real, where, 0)
        yield flat[where].astype(np.int64), fresh[where] & real, np.where(real, owner[where], -1)


def segments(begin: np.ndarray) -> np.ndarray:
    """Bounds of the documents, the long ones cut, so that no lane runs on alone in training."""
    pieces = -(-np.diff(begin) // SEGMENT)
    inside = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return np.append(np.repeat(begin[:-1], pieces) + inside * SEGMENT, begin[-1])


def train(model: Model, optimiser: Adam, symbols: np.ndarray, begin: np.ndarray) -> None:
    state, grad = None, model.like(optimiser.gradient)
    for steps, fresh, owner in windows(symbols, begin):
        state = np.zeros((steps.shape[1], model.width), np.float32) if state is None else state[: steps.shape[1]]
        hidden, kept, state = forward(model, steps, fresh, state)
        real, states, chosen = owner.ravel() >= 0, hidden.reshape(-1, model.width), steps.ravel()
        if real.all():
            _, errors = output(model, states, chosen, grad)
        else:
            errors = np.zeros_like(states)
            _, errors[real] = output(model, states[real], chosen[real], grad)
        backward(model, grad, steps, fresh, hidden, kept, errors.reshape(hidden.shape))
        optimiser.update(model.vector, 1 / max(1, int(real.sum())))


def score(model: Model, symbols: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Natural log-probability of each document, its state carried through all windows.

    States of several windows are read out together, so that a long document that runs on
    alone costs no more reading than others.
    """
    total, state = np.zeros(len(begin) - 1), None
    held, size = [], 0

    def read_out() -> None:
        hidden, steps, owner = (np.concatenate(side) for side in zip(*held))
        logp, _ = output(model, hidden, steps)
        np.add(total, np.bincount(owner, logp.astype(np.float64), len(total)), out=total)

    for steps, fresh, owner in windows(symbols, begin):
        state = np.zeros((steps.shape[1], model.width), np.float32) if state is None else state[: steps.shape[1]]
        hidden, _, state = forward(model, steps, fresh, state, keep=False)
        real = owner.ravel() >= 0
        found = hidden.reshape(-1, model.width), steps.ravel(), owner.ravel()
        held.append(found if real.all() else tuple(side[real] for side in found))
        size += len(held[-1][1])
        if size >= READ_OUT:
            read_out()
            held, size = [], 0
    if held:
        read_out()
    return total


def joined(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of some texts one after the other, and where each begins."""
    begin = np.cumsum([0, *map(len, parts)])
    return np.concatenate(parts), begin


def gathered(batches, words: int = 1_500_000):
    """Rows and symbols of enough texts to fill the lanes, or of what is left."""
    rows, held, n = [], [], 0
    for batch in batches:
        done = 0
        for i, coded in enumerate(batch.column("symbols")):
            held.append(np.frombuffer(coded.as_py(), "<u4").astype(np.int32))
            n += len(held[-1])
            if n >= words:
                yield [*rows, batch.slice(done, i + 1 - done)], held
                rows, held, n, done = [], [], 0, i + 1
        if done < batch.num_rows:
            rows.append(batch.slice(done))
    if held:
        yield rows, held


_WEIGHTS = "slice long, at binary, weights binary, seen binary, trainer long"


def averaged(trained: DataFrame, trainers: int) -> DataFrame:
    """Sums over trainers of weight changes times words seen, in steps of ``FAN`` trainers.

    No task holds more than one slice's sums at a time for the slices it has.
    """
    def add_up(batches):
        sums: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                total, seen = sums.setdefault(
                    (row["slice"], row["trainer"]), (np.zeros((SLICE, PIECE), np.float32), np.zeros(SLICE)))
                at = np.frombuffer(row["at"], "<i4")
                own = np.frombuffer(row["seen"], np.float64)
                weights = np.frombuffer(row["weights"], np.float16).reshape(-1, PIECE).astype(np.float32)
                total[at] += weights * own.astype(np.float32)[:, None]
                seen[at] += own
        for (number, trainer), (total, seen) in sums.items():
            at = np.flatnonzero(seen)
            mean = (total[at] / seen[at].astype(np.float32)[:, None]).astype(np.float16)
            yield {"slice": [number], "at": [at.astype("<i4").tobytes()], "weights": [mean.tobytes()],
                   "seen": [seen[at].tobytes()], "trainer": [trainer]}

    while True:
        trainers = -(-trainers // FAN)
        grouped = trained.withColumn("trainer", F.col("trainer") % trainers)
        # in a fixed order, as sums of floats depend on it
        placed = grouped.repartition("slice", "trainer").sortWithinPartitions(
            "slice", "trainer", F.xxhash64("at", "weights"))
        trained = arrow_map(placed, add_up, _WEIGHTS)
        if trainers == 1:
            return trained


def fitted(training: DataFrame, cuts: np.ndarray, counts: np.ndarray, tokens: int) -> Model:
    """Weights after one pass over all training texts in rows of ``deal, symbols``.

    Each trainer reads its share of the texts with truncated backpropagation, from the common
    weights of the round. A piece of the weights moves by the average over the trainers that
    moved it, by the words they saw. Trainers hand on only such pieces, as half-precision
    differences, and the averages are made in tasks: one vector of differences comes to the
    driver, however many trainers there are.
    """
    model = Model(cuts)
    model.start_from(counts)
    spark, size, width = training.sparkSession, len(model.vector), model.width
    trainers = max(1, round(4 * (tokens / TRAINER_TOKENS) ** 0.5))
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast((cuts, model.vector))

        def run(batches):
            bounds, start = shared.value
            own, optimiser = Model(bounds, width, start.copy()), Adam(size)
            optimiser.step = 60 * turn
            seen = 0
            for _, held in gathered(batches):
                symbols, begin = joined(held)
                seen += len(symbols)
                train(own, optimiser, symbols, segments(begin))
            moved = np.flatnonzero(optimiser.steps)
            changes = (own.vector - start).reshape(-1, PIECE)
            parts = np.flatnonzero(np.diff(moved // SLICE)) + 1
            for at in np.split(moved, parts) if len(moved) else ():
                yield {"slice": [at[0] // SLICE], "at": [(at % SLICE).astype("<i4").tobytes()],
                       "weights": [changes[at].astype(np.float16).tobytes()],
                       "seen": [np.full(len(at), float(seen)).tobytes()],
                       "trainer": [TaskContext.get().partitionId()]}

        part = training.where(F.pmod("deal", F.lit(ROUNDS)) == turn)
        dealt = part.repartition(trainers, "deal").sortWithinPartitions("deal").select("symbols")
        vector = model.vector.copy()
        pieces = vector.reshape(-1, PIECE)
        for row in averaged(arrow_map(dealt, run, _WEIGHTS), trainers).toLocalIterator():
            at = np.frombuffer(row["at"], "<i4") + row["slice"] * SLICE
            pieces[at] += np.frombuffer(row["weights"], np.float16).reshape(-1, PIECE)
        model = model.like(vector)
        shared.unpersist()
    return model


def vocabulary_size(tokens: int) -> int:
    return int(VOCABULARY * tokens**POWER)


def _level() -> Column:
    return F.floor(F.log2("n") * LEVELS)


def least_counts(counts: DataFrame, *sizes: int) -> list[int]:
    """For each size the level of counts from which at most so many words are left.

    A level holds counts that differ by a few percent; there are a few hundred levels. A level
    that no count reaches stands for no words.
    """
    levels = sorted(
        counts.groupBy(_level().alias("level")).agg(F.count("word").alias("words")).collect(),
        key=lambda r: -r["level"])
    found = []
    for size in sizes:
        reach, least = 0, levels[0]["level"] + 1 if levels else 1
        for r in levels:
            reach += r["words"]
            if reach > size:
                break
            least = r["level"]
        found.append(least)
    return found


class Vocabulary:
    """Symbols and counts of the words that tasks hold.

    ``words`` (sorted hashes) have ``counts``, and ``symbols`` if they are in the vocabulary
    (else -1). ``rare`` are the symbols of the rare words, ``rare_logs`` the log10 of what their
    counts are shares of. Symbols are numbered by count, the most frequent first.
    """

    def __init__(self, counts: DataFrame, tokens: int, ends: int):
        own, shared = least_counts(counts, vocabulary_size(tokens), LOOKUP_WORDS)
        self.held = min(own, shared)  # level from which words are held by tasks
        rare = max(LEAST_RARE, vocabulary_size(tokens) // RARE_SHARE)
        level = _level()
        table = counts.where(level >= self.held).select("word", "n", (level >= own).alias("own")).toArrow()
        words, n, frequent = (table.column(c).to_numpy() for c in ("word", "n", "own"))
        order = np.argsort(words.view(np.uint64))
        self.words, self.counts, frequent = words.view(np.uint64)[order], n[order], frequent[order]
        sums = np.zeros((rare, 2))
        for r in counts.where(level < own).groupBy((F.col("ending") % rare).alias("rare")).agg(
                F.sum("n").alias("n"), F.count("word").alias("words")).collect():
            sums[r["rare"]] = r["n"], r["words"]
        self.rare_logs = np.log10(sums[:, 0] + 0.5 * (sums[:, 1] + 1))
        found = np.flatnonzero(frequent)
        weights = np.concatenate([[ends], sums[:, 0], self.counts[found]]).astype(float)
        # the end is symbol 0 and a class of its own
        rank = np.concatenate([[0], 1 + np.argsort(-weights[1:], kind="stable")])
        number = np.empty(len(rank), np.int32)
        number[rank] = np.arange(len(rank), dtype=np.int32)
        self.rare = number[1: 1 + rare]
        self.symbols = np.full(len(self.words), -1, np.int32)
        self.symbols[found] = number[1 + rare:]
        self.weights = weights[rank]
        self.cuts = np.concatenate([[0], 1 + class_cuts(self.weights[1:])])

    def coded(self, hashes: np.ndarray, tails: np.ndarray):
        """Of each word: symbol, whether it is rare, and its count or -1 if tasks don't hold it."""
        if not len(self.words):
            return self.rare[tails % len(self.rare)], np.ones(len(hashes), bool), np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = self.words[at] == hashes
        symbol = np.where(known, self.symbols[at], -1)
        rare = symbol < 0
        return np.where(rare, self.rare[tails % len(self.rare)], symbol), rare, np.where(known, self.counts[at], -1)


def looked_up(block: tx.Block, hashes: np.ndarray, vocabulary: Vocabulary):
    """Which distinct word each word is, and of those the endings and what the vocabulary says.

    Each distinct word of the block is looked up once, in order of the hashes.
    """
    order, begin, often = groups(hashes)
    word = np.empty(len(hashes), np.int64)
    word[order] = np.repeat(np.arange(len(begin)), often)
    first = order.take(begin)
    tails = endings(block, first)
    return word, tails, vocabulary.coded(hashes.take(first), tails)


def coded(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Symbols and count sums of each row, and the words whose counts a join must find."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        for rows_, block in tx.blocks(batches, fold=True):
            held, size = shared.value, len(block)
            hashes, owner = block.hashes(), block.owners()
            word, tails, (symbol, rare, n) = looked_up(block, hashes, held)
            known = n >= 0
            logs = np.where(known, np.log10(np.maximum(n, 0) + 0.5), 0)
            shared_logs = np.where(rare, held.rare_logs[tails % len(held.rare)], 0)

            def by_text(values):
                return np.bincount(owner, values.take(word), size)

            begin = block.first + np.arange(size + 1)
            text = np.full(begin[-1], END, "<u4")
            text[np.arange(len(hashes)) + owner] = symbol.take(word)
            key = (part << 33) + number + np.arange(size)
            number += size
            # words beyond the shared counts are looked up by a join, once per text
            open_ = np.flatnonzero(~known.take(word))
            order, first, repeat = groups(tx.mix(hashes[open_] ^ tx.mix(owner[open_].astype(np.uint64))))
            first = open_[order.take(first)]
            where = np.argsort(owner[first], kind="stable")
            cuts = np.searchsorted(owner[first][where], np.arange(size + 1))
            looked, often = hashes[first][where].view(np.int64), repeat[where]
            yield {
                "doc_id": rows_.column("doc_id"), "held_out": rows_.column("held_out"),
                "_key": key, "n_tokens": block.counts + 1,
                "_known": by_text(known).astype(np.int64), "_logs": by_text(logs),
                "_rare_logs": by_text(np.where(rare, logs, 0)) - by_text(shared_logs),
                "_rare": by_text(rare).astype(np.int64),
                "_words": [looked[a:b] for a, b in zip(cuts[:-1], cuts[1:])],
                "_times": [often[a:b] for a, b in zip(cuts[:-1], cuts[1:])],
                "symbols": [text[a:b].tobytes() for a, b in zip(begin[:-1], begin[1:])]}

    found = arrow_map(
        rows, run, "doc_id long, held_out boolean, _key long, n_tokens long, _known long, "
        "_logs double, _rare_logs double, _rare long, _words array<long>, _times array<long>, "
        "symbols binary")
    return materialize(found.withColumn("deal", F.xxhash64("doc_id", "symbols")), "coded")


def rate(docs: DataFrame) -> DataFrame:
    """Scores of every row of ``doc_id, text``; learning leaves out held-out rows.

    Held out are rows whose id's text has a crc32 of 1 modulo 5 (a null id counts as an empty
    text). Words are lower-cased in A-Z and told apart by 64-bit hashes; every text ends in one
    end token, and a null or empty text is that token alone. ``base_score`` is the add-half
    unigram log10 probability, ``score`` the network's; ``n_rare`` counts words that share a
    symbol with others. Repeated rows are scored alike; without training rows both fall back to
    equal shares of one unknown word. An empty table gives no rows.
    """
    rows = spread(docs.select("doc_id", "text")).withColumn("held_out", held_out())
    training = rows.where("not held_out")
    counts = materialize(word_counts(training), "word-counts")
    ends = training.count()
    summary = counts.agg(F.count("word"), F.sum("n")).first()
    distinct, tokens = summary[0] + (ends > 0), (summary[1] or 0) + ends
    vocabulary = Vocabulary(counts, tokens, ends)
    texts = coded(rows, vocabulary)
    model = fitted(
        texts.where("not held_out").select("deal", "symbols"), vocabulary.cuts, vocabulary.weights, tokens)
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.cuts, model.vector))
    width = model.width

    def run(batches):
        cuts, vector = shared.value
        own = Model(cuts, width, vector)
        for parts, held in gathered(batches, GROUP):
            logp, done = score(own, *joined(held)), 0
            for part in parts:
                yield {c: part.column(c) for c in part.schema.names if c != "symbols"} | {
                    "_network": logp[done: done + part.num_rows]}
                done += part.num_rows

    # stored, so that the network runs once, whatever the join does
    scored = materialize(arrow_map(
        texts.drop("_words", "_times", "deal"), run,
        "doc_id long, held_out boolean, _key long, n_tokens long, _known long, _logs double, "
        "_rare_logs double, _rare long, _network double"), "scored")
    pairs = texts.select("_key", F.explode(F.arrays_zip("_words", "_times")).alias("p")).select(
        "_key", F.col("p._words").alias("word"), F.col("p._times").alias("times"))
    tail = counts.where(_level() < vocabulary.held).select("word", F.col("n").alias("c"))
    c = F.coalesce("c", F.lit(0))
    looked = pairs.join(tail, "word", "left").groupBy("_key").agg(
        F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("_more_known"),
        F.sum(F.col("times") * F.log10(c + 0.5)).alias("_more_logs"))
    whole = float(np.log10(tokens + 0.5 * (distinct + 1)))
    end = float(np.log10(ends + 0.5))
    more_known = F.coalesce("_more_known", F.lit(0))
    more_logs = F.coalesce("_more_logs", F.lit(0.0))
    return scored.join(looked, "_key", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("_known") + more_known + int(ends > 0)).alias("n_known"),
        F.lit(int(tokens)).cast("bigint").alias("train_tokens"),
        (F.col("_logs") + more_logs + end - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("_network") / float(np.log(10)) + F.col("_rare_logs") + more_logs).alias("score"),
        F.col("_rare").alias("n_rare"))
