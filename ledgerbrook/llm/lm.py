"""Scoring texts with a gated recurrent language model.

Tokens are the words of a text (A-Z in lower case) and one end.  Spark counts them over all training
texts.  The most frequent words have a place of their own in the model, ``PER_CLASS`` to a class;
all others fall into classes by their last letters, and inside such a class a word has the
share its count gives it (one more for each, and one for the unknown).  A gated recurrent unit
predicts the class and, for frequent words, the word in its class:
P(word) = P(class | state) * P(word | class, state).

Training is truncated backpropagation through time in numpy, on every training text in each of
``ROUNDS`` rounds.  Every partition trains its own copy and Spark averages the copies, block by
block, after each round.  Scoring steps through the texts of an Arrow
batch side by side, in windows; the state is carried from window to window to a text's end.

Counts that do not fit the broadcast table of frequent words (a fixed number of entries) are joined
to the texts' remaining words by Spark.  Null texts are empty: one token, the end.  Repeated rows are
scored alike (and count twice in training); an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import top_by_count
from .arrays import Texts, mix, signed, slices, texts_of, words_of
from .tables import saved

STATE = 24
PER_CLASS, FREQUENT_CLASSES = 32, 32
RARE_CLASSES = 64
CLASSES = FREQUENT_CLASSES + RARE_CLASSES
PLACES = PER_CLASS * FREQUENT_CLASSES  # ids of frequent words; rare classes follow

# Words with a broadcast count (12 bytes each).
TABLE_WORDS = 1 << 19
# Counts from here on are one number when the least count of the table is looked for.
CLIPPED = 1 << 16
ROUNDS = 2
BATCH_TEXTS, WINDOW = 32, 16
RATE = 0.01
CHUNK = 1 << 11  # tokens whose outputs are computed at once
ADAM_PART = 1 << 14  # weights updated at once
MOST = np.float32(80)  # larger numbers have no exponential of 32 bits
BLOCK = 1 << 12  # numbers in a block of averaged weights

END = np.uint64(0x9D39247E33776D41)


# ---- tokens ---------------------------------------------------------------------------------


class Tokens(NamedTuple):
    """The tokens of some texts: word, rare class; text i has first[i] to first[i + 1]."""

    word: np.ndarray
    rare: np.ndarray
    first: np.ndarray


def tokens_of(texts: Texts) -> Tokens:
    words = words_of(texts, lower=True)
    n = len(texts.offsets) - 1
    first = words.first + np.arange(n + 1)
    word = np.full(first[-1] if n else 0, END)
    inner = np.ones(len(word), dtype=bool)
    inner[first[1:] - 1] = False
    word[inner] = words.hash
    last = texts.data[words.end - 1].astype(np.uint64)
    before = np.where(words.end - words.start > 1, texts.data[words.end - 2], 0).astype(np.uint64)
    rare = np.zeros(len(word), np.int8)
    rare[inner] = (mix(last << np.uint64(8) | before) % np.uint64(RARE_CLASSES)).astype(np.int8)
    return Tokens(word, rare, first)


def counts(texts: DataFrame) -> DataFrame:
    """``word, rare, c`` over texts, added up per task before the shuffle."""

    def add(parts: list) -> list:
        word = np.concatenate([p[0] for p in parts])
        order = np.argsort(word, kind="stable")
        word = word[order]
        cut = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]])) if len(word) else order
        rare = np.concatenate([p[1] for p in parts])[order][cut]
        c = np.concatenate([p[2] for p in parts])[order]
        return [(word[cut], rare, np.add.reduceat(c, cut) if len(cut) else c)]

    def batch_of(word, rare, c) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(word.view(np.int64)), pa.array(rare), pa.array(c)], names=["word", "rare", "c"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list = []
        for batch in slices(batches, "text"):
            tokens = tokens_of(texts_of(batch.column(0)))
            parts += add([(tokens.word, tokens.rare, np.ones(len(tokens.word), np.int64))])
            if sum(len(p[0]) for p in parts) > 1 << 20:
                parts = add(parts)
                if len(parts[0][0]) > 1 << 19:
                    yield batch_of(*parts.pop())
        if parts:
            yield batch_of(*add(parts)[0])

    made = texts.mapInArrow(run, "word bigint, rare tinyint, c bigint")
    return made.groupBy("word").agg(F.first("rare").alias("rare"), F.sum("c").alias("c"))


class Vocabulary(NamedTuple):
    """Sorted words with their counts and places (-1: not a frequent word); totals of the corpus."""

    word: np.ndarray
    c: np.ndarray
    place: np.ndarray
    rare_total: np.ndarray
    place_count: np.ndarray
    tokens: int
    types: int


def _held(counted: DataFrame) -> DataFrame:
    """The most frequent words, ``TABLE_WORDS`` at most: all that reach a count or, if even the largest
    counted one has too many, as many as there is room for, by count and then by word; always with the end."""
    sizes = counted.groupBy(F.least("c", F.lit(CLIPPED)).alias("c")).agg(F.count("*").alias("n")).orderBy(F.desc("c"))
    least, held = 0, 0
    for row in sizes.collect():  # at most CLIPPED counts
        held += row.n
        if held > TABLE_WORDS:
            break
        least = row.c
    if least:
        return counted.where(F.col("c") >= least)
    end = F.lit(int(signed(np.array([END]))[0]))
    others = top_by_count(counted.where(F.col("word") != end), "word", TABLE_WORDS - 1, count="c")
    return others.drop("rank").unionByName(counted.where(F.col("word") == end))


def vocabulary(counted: DataFrame) -> Vocabulary:
    """The frequent words, as many as the table may hold, and the totals."""
    total = counted.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    rows = _held(counted).select("word", "rare", "c").toArrow()
    word, c = rows["word"].to_numpy().view(np.uint64), rows["c"].to_numpy()
    order = np.argsort(word)
    word, c = word[order], c[order]
    rank = np.lexsort((word, -c, word != END))[:PLACES]  # the end comes first
    place = np.full(len(word), -1, np.int32)
    place[rank] = np.arange(len(rank))
    place_count = np.zeros(PLACES)
    place_count[: len(rank)] = c[rank]
    rare = np.ones(RARE_CLASSES)
    by_class = counted.groupBy("rare").agg(F.sum(F.col("c") + 1).alias("mass")).collect()
    for row in by_class:
        rare[row.rare] += row.mass
    own = rows["rare"].to_numpy()[order]
    np.add.at(rare, own[place >= 0].astype(int), -(c[place >= 0] + 1.0))
    return Vocabulary(word, c, place, rare, place_count, total.n or 0, total.v)


def looked_up(words: Vocabulary, tokens: Tokens) -> tuple[np.ndarray, np.ndarray]:
    """The model's id of each token, and its count, or -1 where the table does not have it."""
    if not len(words.word):
        return PLACES + tokens.rare.astype(np.int32), np.full(len(tokens.word), -1, np.int64)
    at = np.minimum(np.searchsorted(words.word, tokens.word), len(words.word) - 1)
    held = words.word[at] == tokens.word
    place = np.where(held, words.place[at], -1)
    return np.where(place >= 0, place, PLACES + tokens.rare.astype(np.int32)), np.where(held, words.c[at], -1)


# ---- the model ------------------------------------------------------------------------------


def new_model(words: Vocabulary) -> dict[str, np.ndarray]:
    """Weights near zero with the corpus's shares as biases: before training, a unigram model."""
    draw = np.random.default_rng(7)
    masses = np.concatenate([words.place_count.reshape(FREQUENT_CLASSES, PER_CLASS).sum(axis=1), words.rare_total])
    inside = np.maximum(words.place_count.reshape(FREQUENT_CLASSES, PER_CLASS), 1e-4)
    shapes = {
        "into": (PLACES + RARE_CLASSES, 3 * STATE),
        "gates": (STATE, 2 * STATE),
        "fresh": (STATE, STATE),
        "classes": (STATE, CLASSES),
        "members": (FREQUENT_CLASSES, STATE, PER_CLASS),
    }
    model = {name: draw.normal(0, 0.1, shape).astype(np.float32) for name, shape in shapes.items()}
    model["class_bias"] = np.log(np.maximum(masses, 1e-4)).astype(np.float32)
    model["member_bias"] = np.log(inside).astype(np.float32)
    return model


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def step(model: dict, state: np.ndarray, ids: np.ndarray) -> tuple:
    """The state after a token, and what the way back needs."""
    given = model["into"][ids]
    gates = _sigmoid(given[:, : 2 * STATE] + state @ model["gates"])
    keep, reset = gates[:, :STATE], gates[:, STATE:]
    inner = state @ model["fresh"]
    fresh = np.tanh(given[:, 2 * STATE :] + reset * inner)
    return fresh + keep * (state - fresh), keep, reset, inner, fresh


class Unit:
    """The recurrent unit made ready for many steps; states and all else lie as features x texts.

    A gate is 1 / (1 + exp(-x)), its minus taken into the weights.
    """

    def __init__(self, model: dict) -> None:
        self.into = model["into"]
        self.weights = np.concatenate([-model["gates"], model["fresh"]], axis=1).T.copy()

    def given(self, ids: np.ndarray) -> np.ndarray:
        """What the tokens (steps x texts) put in, as steps x features x texts."""
        given = self.into.take(ids, axis=0).transpose(0, 2, 1).copy()
        gates = given[:, : 2 * STATE]
        np.negative(gates, out=gates)
        return given

    def step(self, state: np.ndarray, given: np.ndarray, sums: np.ndarray, after: np.ndarray) -> None:
        """Puts the gates and the fresh state in place of ``given``, the weighted state into ``sums``."""
        np.dot(self.weights, state, out=sums)
        gates, fresh = given[: 2 * STATE], given[2 * STATE :]
        gates += sums[: 2 * STATE]
        np.minimum(gates, MOST, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        np.multiply(gates[STATE:], sums[2 * STATE :], out=after)
        fresh += after
        np.tanh(fresh, out=fresh)
        np.subtract(state, fresh, out=after)
        after *= gates[:STATE]
        after += fresh


def _places(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """The class of each token; the frequent ones by class, and ``(class, range)`` in that order."""
    frequent = ids < PLACES
    cls = np.where(frequent, ids // PER_CLASS, ids - (PLACES - FREQUENT_CLASSES))
    order = np.flatnonzero(frequent)
    own = cls[order].astype(np.int8)
    order = order[np.argsort(own, kind="stable")]
    ends = np.concatenate([[0], np.cumsum(np.bincount(own, minlength=FREQUENT_CLASSES))]).tolist()
    return cls, order, [(c, slice(a, b)) for c, (a, b) in enumerate(zip(ends, ends[1:])) if a < b]


def _exps(x: np.ndarray, axis: int) -> np.ndarray:
    """Turns logits into their exponentials over the largest along an axis; gives their sums."""
    x -= x.max(axis=axis, keepdims=True)
    np.exp(x, out=x)
    return x.sum(axis=axis, keepdims=True)


def _inside(model: dict, h: np.ndarray, some: np.ndarray, parts: list) -> np.ndarray:
    """Logits of the words of a class, for tokens (by class) and the states before them, a token a row."""
    inside = np.empty((len(some), PER_CLASS), h.dtype)
    members = model["members"]
    for c, at in parts:
        np.dot(h[at], members[c], out=inside[at])
    inside += model["member_bias"].take(some // PER_CLASS, axis=0)
    return inside


def _log_likelihood(model: dict, h: np.ndarray, some: np.ndarray) -> np.ndarray:
    cls, order, parts = _places(some)
    logits = model["classes"].T @ h
    logits += model["class_bias"][:, None]
    got = logits[cls, np.arange(len(some))] - logits.max(axis=0)
    got = got.astype(np.float64) - np.log(_exps(logits, 0)[0])
    if len(order):
        own = some[order]
        inside = _inside(model, h.T.take(order, axis=0), own, parts)
        more = inside[np.arange(len(own)), own % PER_CLASS] - inside.max(axis=1)
        got[order] += more - np.log(_exps(inside, 1)[:, 0])
    return got


def log_likelihood(model: dict, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Natural logarithms of P(class) and, for frequent words, P(word | class)."""
    out = np.empty(len(ids), np.float64)
    for low in range(0, len(ids), CHUNK):
        some = slice(low, low + CHUNK)
        out[some] = _log_likelihood(model, states[some].T.copy(), ids[some])
    return out


def gradients(
    model: dict, state: np.ndarray, ids: np.ndarray, live: np.ndarray, grads: dict | None = None
) -> tuple[dict, np.ndarray]:
    """Gradients of the loss over one window (texts x steps), and the state it ends in.

    ``live`` masks the steps past a text's end: nothing comes back from them, and the state of a text that has ended
    means nothing.  Nothing flows back beyond the window.  ``grads`` are arrays of zeros to be filled.
    """
    n, steps = ids.shape
    kind = state.dtype
    if grads is None:
        grads = {name: np.zeros_like(value) for name, value in model.items()}
    unit = Unit(model)
    rows = ids.T.ravel()
    way = unit.given(ids.T)
    sums = np.empty((steps, 3 * STATE, n), kind)
    states = np.empty((steps + 1, STATE, n), kind)
    states[0] = state.T
    for t in range(steps):
        unit.step(states[t], way[t], sums[t], states[t + 1])
    # Back through the two softmaxes, for all steps at once.
    h = before = states[:-1].transpose(1, 0, 2).reshape(STATE, -1)
    some, on = rows, None
    if not live.all():
        on = np.flatnonzero(live.T.ravel())
        some, h = rows[on], before[:, on]
    cls, order, parts = _places(some)
    out = model["classes"].T @ h
    out += model["class_bias"][:, None]
    out *= 1 / _exps(out, 0)
    out[cls, np.arange(len(some))] -= 1
    np.matmul(h, out.T, out=grads["classes"])
    out.sum(axis=1, out=grads["class_bias"])
    back = model["classes"] @ out
    if len(order):
        own, h = some[order], h.T.take(order, axis=0)
        inside = _inside(model, h, own, parts)
        inside *= 1 / _exps(inside, 1)
        inside[np.arange(len(own)), own % PER_CLASS] -= 1
        member_grads, members_back = grads["members"], model["members"].transpose(0, 2, 1).copy()
        from_members = np.empty_like(h)
        for c, at in parts:
            part = inside[at]
            np.dot(h[at].T, part, out=member_grads[c])
            np.dot(part, members_back[c], out=from_members[at])
        found = [c for c, _ in parts]
        grads["member_bias"][found] = np.add.reduceat(inside, [at.start for _, at in parts], axis=0)
        back[:, order] += from_members.T
    if on is not None:
        from_outputs = np.zeros_like(before)
        from_outputs[:, on] = back
        back = from_outputs
    back = back.reshape(STATE, steps, n).transpose(1, 0, 2).copy()
    # Back through the unit: all that does not depend on what comes back is made for all steps at once.
    keep, reset, fresh, inner = way[:, :STATE], way[:, STATE : 2 * STATE], way[:, 2 * STATE :], sums[:, 2 * STATE :]
    lose = 1 - keep
    d_fresh = lose * (1 - fresh * fresh)
    slopes = np.empty((steps, 3, STATE, n), kind)
    np.multiply((states[:-1] - fresh) * keep, lose, out=slopes[:, 0])
    np.multiply(d_fresh, reset, out=slopes[:, 2])
    np.multiply(slopes[:, 2], inner * (1 - reset), out=slopes[:, 1])
    weights = np.concatenate([model["gates"], model["fresh"]], axis=1)
    downs = np.empty((steps, STATE, n), kind)
    down, passed = np.zeros((STATE, n), kind), np.empty((STATE, n), kind)
    for t in range(steps - 1, -1, -1):
        downs[t] = down
        slope = slopes[t]
        slope *= down
        np.matmul(weights, slope.reshape(3 * STATE, n), out=passed)
        down *= keep[t]
        down += passed
        down += back[t]
    d_fresh *= downs
    flat = slopes.transpose(1, 2, 0, 3).reshape(3 * STATE, steps * n)
    np.matmul(before, flat[: 2 * STATE].T, out=grads["gates"])
    np.matmul(before, flat[2 * STATE :].T, out=grads["fresh"])
    slopes[:, 2] = d_fresh
    d_given = slopes.reshape(steps, 3 * STATE, n).transpose(0, 2, 1).reshape(steps * n, 3 * STATE)
    order = np.argsort(rows.astype(np.int16), kind="stable")
    sorted_rows = rows[order]
    cut = np.flatnonzero(np.concatenate([[True], sorted_rows[1:] != sorted_rows[:-1]]))
    grads["into"][sorted_rows[cut]] = np.add.reduceat(d_given.take(order, axis=0), cut, axis=0)
    return grads, states[-1].T


class Adam:
    """Adam's moments of some weights, which every update changes in place."""

    def __init__(self, flat: np.ndarray, grad: np.ndarray) -> None:
        self._updates = 0
        whole = (flat, grad, np.zeros_like(flat), np.zeros_like(flat))
        self._parts = [tuple(x[i : i + ADAM_PART] for x in whole) for i in range(0, len(flat), ADAM_PART)]

    def update(self, scale: float) -> None:
        """One update by the gradients times ``scale``; they are zeros afterwards."""
        self._updates += 1
        # The moments are kept as sums: 10 times the mean and 100 times the mean square.
        square = 0.1 / math.sqrt(1 - 0.99**self._updates)
        rate = np.float32(0.1 * RATE / (1 - 0.9**self._updates) / square)
        least, scale = np.float32(1e-6 / square), np.float32(scale)
        for flat, grad, first, second in self._parts:
            grad *= scale
            first *= np.float32(0.9)
            first += grad
            grad *= grad
            second *= np.float32(0.99)
            second += grad
            np.sqrt(second, out=grad)
            grad += least
            np.divide(first, grad, out=grad)
            grad *= rate
            flat -= grad
            grad.fill(0)


def train(model: dict, texts: list[np.ndarray]) -> dict:
    """One pass of truncated backpropagation over all texts (their ids), with Adam.

    Texts of about the same length make a batch; batches come in random order.
    """
    flat = _flat(model)
    grad = np.zeros_like(flat)
    model, grads = _shaped(flat, model), _shaped(grad, model)  # parts of ``flat``, which the updates change
    adam = Adam(flat, grad)
    texts = sorted(texts, key=len, reverse=True)
    starts = np.arange(0, len(texts), BATCH_TEXTS)
    for low in np.random.default_rng(len(texts)).permutation(starts).tolist():
        some = texts[low : low + BATCH_TEXTS]
        lengths = np.array([len(t) for t in some])
        state = np.zeros((len(some), STATE), np.float32)
        for start in range(0, int(lengths[0]), WINDOW):
            on = int((lengths > start).sum())
            ids = np.zeros((on, WINDOW), np.int32)
            for row, t in zip(ids, some):
                part = t[start : start + WINDOW]
                row[: len(part)] = part
            live = start + np.arange(WINDOW) < lengths[:on, None]
            _, state = gradients(model, state[:on], ids, live, grads)
            adam.update(1 / int(live.sum()))
    return model


def _flat(model: dict) -> np.ndarray:
    return np.concatenate([model[name].ravel() for name in sorted(model)]).astype(np.float32, copy=False)


def _shaped(flat: np.ndarray, like: dict) -> dict:
    made, at = {}, 0
    for name in sorted(like):
        made[name] = flat[at : at + like[name].size].reshape(like[name].shape)
        at += like[name].size
    return made


def _averaged(copies: DataFrame) -> DataFrame:
    """Weighted sums of blocks in two steps, so that no task gets the copies of all partitions."""

    def add(rows: pa.Table) -> pa.Table:
        weight = rows["weight"].to_numpy()
        total = sum(w * np.frombuffer(v.as_py(), np.float32).astype(np.float64) for w, v in zip(weight, rows["numbers"]))
        mean = (total / weight.sum()).astype(np.float32).tobytes()
        return pa.table({"block": rows["block"][:1], "lot": rows["lot"][:1], "weight": [float(weight.sum())], "numbers": [mean]})

    schema = "block int, lot int, weight double, numbers binary"
    lots = copies.groupBy("block", "lot").applyInArrow(add, schema).withColumn("lot", F.lit(0))
    return lots.groupBy("block").applyInArrow(add, schema)


def trained_model(texts: DataFrame, words: Vocabulary) -> dict:
    """The model after ``ROUNDS`` rounds of local training on all texts and averaging over their partitions."""
    model = new_model(words)
    spark = texts.sparkSession
    shipped_words = spark.sparkContext.broadcast(words)
    for _ in range(ROUNDS):
        shipped = spark.sparkContext.broadcast(model)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, seen, lot = shipped.value, 0, 0
            for batch in slices(batches, "text"):
                tokens = tokens_of(texts_of(batch.column(0)))
                ids, _ = looked_up(shipped_words.value, tokens)
                own = train(own, [ids[a:b] for a, b in zip(tokens.first[:-1], tokens.first[1:])])
                seen += len(ids)
                lot = batch.column(1)[0].as_py()
            if seen:
                flat = _flat(own)
                blocks = [flat[i : i + BLOCK].tobytes() for i in range(0, len(flat), BLOCK)]
                n = len(blocks)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(n, dtype=np.int32)),
                        pa.array(np.full(n, lot, np.int32)),
                        pa.array(np.full(n, float(seen))),
                        pa.array(blocks, pa.binary()),
                    ],
                    names=["block", "lot", "weight", "numbers"],
                )

        lot = (F.spark_partition_id() % 64).alias("lot")
        copies = texts.select("text", lot).mapInArrow(run, "block int, lot int, weight double, numbers binary")
        blocks = sorted(_averaged(copies).collect(), key=lambda row: row.block)  # the model's fixed size
        if blocks:
            model = _shaped(np.concatenate([np.frombuffer(row.numbers, np.float32) for row in blocks]), model)
    return model


def text_scores(model: dict, ids: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The natural log-likelihood of each text, stepping through all of them side by side."""
    lengths = np.diff(first)
    order = np.argsort(-lengths, kind="stable")
    ordered, begin = lengths[order], first[:-1][order]
    total = np.zeros(len(lengths))
    unit = Unit(model)
    kind = unit.weights.dtype
    state = np.zeros((STATE, len(lengths)), kind)
    states, seen, owners = [], [], []

    def add() -> None:
        if seen:
            likely = _log_likelihood(model, np.concatenate(states, axis=1), np.concatenate(seen))
            total[:] += np.bincount(np.concatenate(owners), weights=likely, minlength=len(total))
            for some in (states, seen, owners):
                some.clear()

    waiting = 0
    for t in range(int(ordered[0]) if len(ordered) else 0):
        on = int(np.searchsorted(-ordered, -t, side="left"))
        state = state[:, :on]
        some = ids[begin[:on] + t]
        states.append(state)
        seen.append(some)
        owners.append(np.arange(on))
        after = np.empty((STATE, on), kind)
        unit.step(state, unit.given(some[None])[0], np.empty((3 * STATE, on), kind), after)
        state = after
        waiting += on
        if waiting >= CHUNK:
            add()
            waiting = 0
    add()
    out = np.empty(len(lengths))
    out[order] = total
    return out


# ---- the operator ---------------------------------------------------------------------------


def score(table: DataFrame, *, id: str = "doc_id", text: str = "text", folds: int = 7, held_out: int = 2) -> DataFrame:
    """Per row: the id, ``held_out``, ``n_tokens, n_known, train_tokens, base_score, score``.

    Rows whose crc32(id as text) mod ``folds`` is ``held_out`` are not learned from.  Scores are
    log10 probabilities of the whole text; ``base_score`` is that of the smoothed word counts.
    """
    fold = F.coalesce(F.crc32(F.col(f"`{id}`").cast("string").cast("binary")) % folds, F.lit(-1))
    rows = table.select(
        F.col(f"`{id}`").alias("id"), (fold == held_out).alias("held_out"), F.col(f"`{text}`").cast("binary").alias("text")
    )
    learned = rows.where(~F.col("held_out"))
    counted = saved(counts(learned.select("text")), "counts")
    words = vocabulary(counted)
    share = table.sparkSession.sparkContext.broadcast
    shipped = share((words, trained_model(learned.select("text"), words)))
    kind = table.schema[id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, model = shipped.value
        for batch in slices(batches, "text", 8 << 20):
            tokens = tokens_of(texts_of(batch.column(2)))
            ids, c = looked_up(words, tokens)
            first = tokens.first
            likely = text_scores(model, ids, first) / math.log(10)
            # A rare word's share of its class; what the table does not have is added by the join.
            logs = np.log10(np.maximum(c, 0) + 1.0)
            rare = ids >= PLACES
            shares = np.where(rare, logs - np.log10(words.rare_total)[tokens.rare], 0)
            text_of = np.repeat(np.arange(batch.num_rows), np.diff(first))
            sums = [np.bincount(text_of, weights=x, minlength=batch.num_rows) for x in (shares, logs, c > 0)]
            out = np.flatnonzero(c < 0)
            lists = np.concatenate([[0], np.cumsum(np.bincount(text_of[out], minlength=batch.num_rows))])
            missing = pa.ListArray.from_arrays(pa.array(lists.astype(np.int32)), pa.array(tokens.word[out].view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(3), pa.array(np.diff(first).astype(np.int64)),
                    pa.array(sums[2].astype(np.int64)), pa.array(sums[1]), pa.array(likely + sums[0]), missing,
                ],
                names=["id", "held_out", "row", "n_tokens", "known", "logs", "likely", "missing"],
            )

    schema = (
        f"id {kind}, held_out boolean, row bigint, n_tokens bigint, known bigint, logs double, likely double, "
        "missing array<bigint>"
    )
    numbered = rows.select("id", "held_out", "text", F.monotonically_increasing_id().alias("row"))
    scored = saved(numbered.mapInArrow(run, schema), "scored")
    rest = scored.select("row", F.explode("missing").alias("word")).join(counted.select("word", "c"), "word")
    rest = rest.groupBy("row").agg(
        F.sum(F.log10(F.col("c") + 1)).alias("more_logs"), F.count("*").alias("more_known")
    )
    joined = scored.join(rest, "row", "left")
    more = F.coalesce("more_logs", F.lit(0.0))
    return joined.select(
        F.col("id").alias(id),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("bigint").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * math.log10(words.tokens + words.types + 1)).alias("base_score"),
        (F.col("likely") + more).alias("score"),
    )
