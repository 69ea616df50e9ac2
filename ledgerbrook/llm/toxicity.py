"""Toxicity by weak supervision.

1. Words and word stems that tell labelled toxic texts from clean ones become a lexicon; each entry
   is a *voter*, as are some patterns of writing.  A voter votes or abstains.
2. A generative label model explains the votes of a sample by a hidden label: each voter's rates of
   voting on either label (its accuracy), and the correlations of voters given the label,
   fitted by expectation maximisation.  Correlated voters share their weight.
3. The posterior of the hidden label, as soft labels, trains a linear classifier (logistic
   regression by MLlib) on the lexicon's entries in the texts, which scores every text.

Labels are taken from rows outside the held-out fold only, and at most ``MAX_LABELLED`` of them, chosen
by hash: that sample, its votes and the lexicon are bounded and may be broadcast.  Everything else
runs over all rows without a shuffle.  Null and empty texts have no words and score low.
Repeated rows score alike; without labels of both kinds every score is the share of toxic labels.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import saved

MAX_LABELLED = 20_000
LEXICON = 512
LEAST_DEVIANCE, LEAST_RATIO = 24, 5
STEMS = [4, 5]
DECIDED = 0.7

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def terms(text: Column) -> Column:
    """The distinct words of a text, and their stems: the first letters of longer words, with a hyphen."""
    lower = F.translate(F.coalesce(text, F.lit("")), _LETTERS, _LETTERS.lower())
    words = F.array_distinct(F.split(lower, r"[^\p{L}\p{N}]+"))
    stems = [
        F.transform(
            F.filter(words, lambda word: F.length(word) > STEMS[-1]),
            lambda word, n=n: F.concat(F.substring(word, 1, n), F.lit("-")),
        )
        for n in STEMS
    ]
    return F.array_distinct(F.concat(words, *stems))


def patterns(text: Column) -> list[Column]:
    """Votes by the way of writing: shouting, exclamation marks, insults by starred letters, address."""
    size = F.greatest(F.length(text), F.lit(1))
    return [
        (F.regexp_count(text, F.lit("[A-Z]")) * 2 > size).cast("int"),
        (F.regexp_count(text, F.lit("!")) * 50 > size).cast("int"),
        text.rlike(r"(?i)\b[a-z]\*{2,}[a-z]?\b").cast("int"),
        text.rlike(r"(?i)\byou(r| are|'re)\b").cast("int"),
    ]


def label_model(votes: np.ndarray, start: np.ndarray, steps: int = 15) -> np.ndarray:
    """Posteriors of the hidden label, by EM from ``start``.

    The model has, per voter, the rates at which it votes on either label, and the correlations of the
    voters given the label.  A vote counts with the logarithm of the two rates' ratio, divided by the
    sum of the voter's correlations: voters that say the same share one vote.  An abstention
    says nothing; ``votes`` therefore has a voter for texts on which all others abstain.
    """
    posterior = np.clip(start.astype(float), 0.01, 0.99)
    for _ in range(steps):
        up, down = posterior.sum(), (1 - posterior).sum()
        hits_up, hits_down = posterior @ votes, (1 - posterior) @ votes
        rate_up, rate_down = (hits_up + 0.05) / (up + 0.1), (hits_down + 0.05) / (down + 0.1)
        off_up, off_down = votes - rate_up, votes - rate_down
        spread = (off_up.T * posterior) @ off_up + (off_down.T * (1 - posterior)) @ off_down
        scale = np.sqrt(np.maximum(np.diag(spread), 1e-9))
        shared = np.maximum(spread / scale / scale[:, None], 0)
        np.fill_diagonal(shared, 1)
        weight = np.log(rate_up / rate_down) / (shared**2).sum(axis=0)
        odds = np.log(up / down) + votes @ weight
        posterior = 1 / (1 + np.exp(-np.clip(odds, -12, 12)))
    return posterior


def _lexicon(sample: DataFrame) -> list[str]:
    """The words with the strongest tie to toxic labels: by the deviance of their two rates."""
    total = sample.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).first()
    n1, n0 = total.toxic or 0, total.n - (total.toxic or 0)
    seen = sample.select("toxic", F.explode("words").alias("word"))
    seen = seen.groupBy("word").agg(F.sum("toxic").alias("k1"), F.count("*").alias("k"))
    k1, k0 = F.col("k1"), F.col("k") - F.col("k1")
    rate = F.col("k") / (n1 + n0)
    part = lambda k, n: F.when(k > 0, k * F.log(k / (n * rate))).otherwise(0.0)
    deviance = 2 * (part(k1, n1) + part(k0, n0))
    ranked = seen.where((k1 * n0 > LEAST_RATIO * k0 * n1) & (deviance >= LEAST_DEVIANCE))
    return [row.word for row in ranked.orderBy(-deviance, "word").limit(LEXICON).collect()]


def score(
    table: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic",
    folds: int = 3, held_out: int = 1,
) -> DataFrame:
    """Per row: the id, ``held_out``, ``score`` (0 to 1) and ``predicted``.

    Rows with crc32(id as text) mod ``folds`` equal to ``held_out`` lend no label.
    """
    fold = lambda name: F.coalesce(F.crc32(F.col(name).cast("string").cast("binary")) % folds == held_out, F.lit(False))
    rows = table.select(F.col(f"`{id}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    known = labels.select(F.col(f"`{id}`").alias("id"), F.col(f"`{label}`").cast("int").alias("toxic"))
    known = known.where(F.col("toxic").isNotNull() & ~fold("id"))
    known = known.orderBy(F.xxhash64("id"), "id", "toxic").limit(MAX_LABELLED).groupBy("id").agg(F.max("toxic").alias("toxic"))
    # One text for each labelled id, dealt out by id.
    sample = rows.join(F.broadcast(known), "id").dropDuplicates(["id"])
    sample = sample.select("text", "toxic", terms(F.col("text")).alias("words"), F.monotonically_increasing_id().alias("row"))
    sample = saved(sample, "labelled")
    lexicon = _lexicon(sample)
    entries = F.array(*map(F.lit, lexicon)).cast("array<string>")
    found = F.array_intersect("words", entries)
    cast = sample.select("row", "toxic", found.alias("found"), F.array(*patterns(F.coalesce("text", F.lit("")))).alias("ways")).toArrow()
    truth = cast["toxic"].to_numpy()
    share = float(truth.mean()) if len(truth) else 0.0
    out = [F.col("id").alias(id), fold("id").alias("held_out")]
    if not 0 < share < 1 or not lexicon:
        given = rows.withColumn("score", F.lit(share))
    else:
        place = {word: i for i, word in enumerate(lexicon)}
        votes = np.zeros((len(truth), len(lexicon)))
        for row, words in enumerate(cast["found"].to_pylist()):
            votes[row, [place[word] for word in words]] = 1
        matrix = np.hstack([votes, np.array(cast["ways"].to_pylist(), float)])
        matrix = np.hstack([matrix[:, matrix.std(axis=0) > 0], votes.sum(axis=1, keepdims=True) == 0])
        posterior = label_model(matrix, truth)
        soft = table.sparkSession.createDataFrame(
            list(zip(cast["row"].to_pylist(), posterior.tolist())), "row bigint, posterior double"
        )
        counted = CountVectorizerModel.from_vocabulary(lexicon, "words", "features").setBinary(True)
        taught = sample.join(F.broadcast(soft), "row")
        sides = F.explode(
            F.array(
                F.struct(F.lit(1.0).alias("label"), F.col("posterior").alias("weight")),
                F.struct(F.lit(0.0).alias("label"), (1 - F.col("posterior")).alias("weight")),
            )
        ).alias("side")
        taught = counted.transform(taught).select("features", sides).select("features", "side.*").where("weight > 0.001")
        taught = saved(taught, "taught")
        learner = LogisticRegression(weightCol="weight", regParam=1e-3, standardization=False, maxIter=60)
        model = learner.fit(taught)
        ready = counted.transform(rows.withColumn("words", terms(F.col("text"))))
        given = model.transform(ready).withColumn("score", vector_to_array("probability")[1])
    return given.select(*out, "score", (F.col("score") >= DECIDED).cast("int").alias("predicted"))
