"""The prefix trie, ranked search and fingerprints against brute force, on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerbrook.llm import fingerprints, lexical_search, prefix_trie
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# Prefix trie.

TURNS = "conv_id bigint, turn bigint, role string, text string, position string, n_turns int"


def brute_trie(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text, *_ in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            name = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            convs[conv_id].append(((turn is not None, turn or 0, name), (role, text)))
    own = {c: [turn for _, turn in sorted(turns, key=lambda t: t[0])] for c, turns in convs.items()}
    paths = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, path in sorted(paths.items()):
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, inside in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(inside) - 1) * len(WORD.findall(node[-1][1])) if node else 0
    return sorted(
        (
            inside[0], len(node), members[node[:-1]][0] if node else -1, len(inside), children[node], leaves[node],
            saved[node], hashlib.sha256(",".join(str(c) for c in inside if paths[c] == node).encode()).hexdigest(),
        )
        for node, inside in members.items()
    )


def built_trie(table):
    nodes = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.ordered_turns(table)))
    return sorted(tuple(-1 if x is None else x for x in row) for row in nodes.collect())


def conversations(seed, n):
    draw = random.Random(seed)
    rows = []
    for c in range(n):
        if c % 7 == 6:
            continue  # no such conversation, now and then the family's first
        length = draw.choice([1, 1, 2, 3, 5, 8])
        kind = draw.randrange(3)
        for t in range(length):
            text = draw.choice(["hello there you", "how  are\tyou", "", None]) if kind else f"own words {c} {t}"
            rows.append((c, None if t == 0 and c % 5 == 0 else t, draw.choice(["user", "bot", None]), text, "x", 1))
    rows += [(3, 1, "user", "same turn"), (3, 1, "user", "same turn"), (3, 1, "bot", "same number"), (None, 0, "user", "lost")]
    return [(*row[:4], "clash", 7) for row in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_is_brute_force(spark, seed):
    rows = conversations(seed, 60)
    assert built_trie(spark.createDataFrame(rows, TURNS).repartition(3)) == brute_trie(rows)


def test_trie_of_small_shards_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 3)
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 5)
    monkeypatch.setattr(prefix_trie, "SHARD_PIECES", 2)
    rows = conversations(3, 50)
    assert built_trie(spark.createDataFrame(rows, TURNS).repartition(4)) == brute_trie(rows)


def test_trie_of_long_and_many_equal_conversations(spark):
    rows = [(1, t, "user", f"turn {t} " + "long " * 500, "", 0) for t in range(2500)]
    rows += [(21, t, "user", f"turn {t} " + "long " * 500, "", 0) for t in range(1200)]
    rows += [(c, t, "user", f"turn {t}", "", 0) for c in range(100, 600) for t in range(3)]
    table = spark.createDataFrame(rows, TURNS)
    turns = prefix_trie.ordered_turns(table).withColumn("n_turns", F.lit(0))
    # Not rebuilt: prefixes beyond a block are shared.
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("n_turns"))
    opening = sizes.select("conv_id", F.expr("0L position"), F.expr("string(null) name"), F.expr("0L words"), "n_turns")
    whole = turns.drop("n_turns").join(sizes, "conv_id").unionByName(opening)
    found = {(r.depth, r.conv_id): r for r in prefix_trie.trie(whole).collect()}
    assert len(found) == len(set((r.depth, r.conv_id) for r in found.values())) == 1 + 2500 + 3
    assert found[0, 1].n_convs == 502 and found[0, 1].n_leaves == 2 and found[0, 1].n_children == 2
    assert found[1200, 1].n_convs == 2 and found[1201, 1].n_convs == 1
    assert found[1200, 1].ends_sha256 == hashlib.sha256(b"21").hexdigest()
    assert found[3, 100].ends_sha256 == hashlib.sha256(",".join(map(str, range(100, 600))).encode()).hexdigest()
    assert found[1000, 1].saved_tokens == 502 * 201 and found[1, 100].saved_tokens == 499 * 6


def test_trie_of_nothing(spark):
    assert built_trie(spark.createDataFrame([], TURNS)) == []
    assert built_trie(spark.createDataFrame([(None, 1, "a", "b", "", 0)], TURNS)) == []


def test_turnless_conversations_end_at_the_root(spark):
    rows = [(c, 0, "user", "only", "", 0) for c in range(21, 40)]  # their family's first is not there
    found = built_trie(spark.createDataFrame(rows, TURNS))
    assert found == brute_trie(rows)
    assert any(row[1] == 0 and row[-1] != hashlib.sha256().hexdigest() for row in found)


# Ranked search.

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id bigint, text string, rank int, score string, query string, n int, at int"
ITEMS = "item_id string, text string, rank int, doc_id bigint"


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def brute_search(docs, items, best=50):
    bags = [(row[0], Counter(terms(row[1]))) for row in docs]
    bags = [(i, bag) for i, bag in bags if bag]
    count, total = len(bags), sum(sum(bag.values()) for _, bag in bags)
    df = Counter(t for _, bag in bags for t in bag)
    found = []
    for item in items:
        hits = []
        for i, bag in bags:
            m = 100 - 50 + (50 * sum(bag.values()) * count) // total
            score = 0
            for t in set(terms(item[1])):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m))
            if score:
                hits.append((-score, i is None, i or 0))
        found += [(item[0], r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(hits)[:best])]
    return sorted(found, key=repr)


def searched(spark, docs, items, **options):
    docs = spark.createDataFrame([(*row[:2], 1, "c", "c", 1, 1) for row in docs], DOCS).repartition(3)
    items = spark.createDataFrame([(*row[:2], 1, 1) for row in items], ITEMS)
    out = lexical_search.top_documents(docs, items, **options)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.fixture(scope="module")
def library():
    draw = random.Random(5)
    words = [f"w{i}" for i in range(300)] + ["Ünï", "ÉTÉ", "été", "x1", "A", "a"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, " ".join(draw.choices(words, weights, k=draw.randrange(1, 60)))) for i in range(400)]
    docs += [(400, None), (401, ""), (402, " .,! "), (None, "w1 w2 w3"), (403, "w7 " * 30000 + "w299"), docs[3], docs[3]]
    docs += [(500 + i, "tie w5 w6") for i in range(70)]  # more ties than a list holds
    items = [(f"q{i}", " ".join(draw.choices(words, k=draw.randrange(1, 12)))) for i in range(25)]
    items += [("null", None), ("empty", "..."), ("none", "nowhere"), ("tie", "tie"), (None, "w1 W1 a-A"), ("long", " ".join(words) * 3)]
    return docs, items


def test_search_is_brute_force(spark, library):
    assert searched(spark, *library) == brute_search(*library)


def test_search_in_small_buckets_and_blocks(spark, library, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_QUERIES", 10)
    monkeypatch.setattr(lexical_search, "BLOCK_TERMS", 40)
    monkeypatch.setattr(lexical_search, "BUCKET", 16)
    monkeypatch.setattr(lexical_search, "HELD_VECTORS", 64)
    monkeypatch.setattr(lexical_search, "FOCUS", 2)
    assert searched(spark, *library, best=5) == brute_search(*library, best=5)


def test_search_prunes_without_loss(library):
    """The lists of a local search are those of scoring all, from far fewer scored vectors."""
    draw = np.random.default_rng(1)
    n, places = 5000, 400
    sizes = draw.integers(1, 30, n)
    at = np.concatenate([np.sort(draw.choice(places, s, replace=False)) for s in sizes])
    value = draw.integers(1, 1_000_000, len(at))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    weights = (9000 * draw.random(places) ** 4).astype(np.int64)  # few terms are rare enough to weigh much
    wanted = [np.sort(draw.choice(places, 12, replace=False)) for _ in range(20)]
    dense = np.zeros((n, places), np.int64)
    dense[np.repeat(np.arange(n), sizes), at] = value
    ids = draw.permutation(n)
    lists = lexical_search.Lists(10, np.zeros(20, np.int64))
    scored, rescore = [], lexical_search._rescore
    try:
        lexical_search._rescore = lambda v, q, l, i, chosen: (scored.append(len(chosen)), rescore(v, q, l, i, chosen))
        lexical_search.search(lexical_search.Vectors(ids, starts, at, value), lexical_search.Queries(wanted, weights), lists)
    finally:
        lexical_search._rescore = rescore
    for q, t in enumerate(wanted):
        scores = dense[:, t] @ weights[t]
        order = np.lexsort((ids, -scores))[:10]
        assert lists.scores[q].tolist() == scores[order].tolist() and lists.ids[q].tolist() == ids[order].tolist()
    assert sum(scored) < n * 20 / 2


def test_search_of_nothing(spark, library):
    docs, items = library
    assert searched(spark, [], items) == [] and searched(spark, docs, []) == []
    assert searched(spark, [(1, None)], items) == []


# Fingerprints.

TEXTS = "doc_id bigint, text string, fingerprint string, part int, tie string"


def brute_edited(rows):
    found = []
    for i, text in rows:
        at = rows.index((i, text))
        following = rows[(at + 1) % len(rows)][1]
        third = len(text) // 3
        changed = text[: len(text) - third] + following[:third]
        found.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest()))
    return found


def test_edited_texts_are_brute_force(spark):
    draw = random.Random(2)
    rows = [(i, "".join(draw.choices("abcdé 漢🙂", k=draw.choice([0, 1, 2, 3, 5, 40, 400])))) for i in draw.sample(range(-50, 500), 200)]
    rows += [(1000, "long " * 60000), (1001, "")]
    table = spark.createDataFrame([(i, t or None, "c", 1, "c") for i, t in rows], TEXTS).repartition(5)
    found = sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in fingerprints.edited(table).collect())
    assert found == sorted(brute_edited(sorted(rows, reverse=True)))


def test_edited_with_equal_and_missing_ids(spark):
    rows = [(5, "five five five")] * 4 + [(4, "four")] * 3 + [(None, "nothing at all"), (None, None), (9, "nine nine nine nine")]
    table = spark.createDataFrame([(*row, "c", 1, "c") for row in rows], TEXTS)
    found = fingerprints.edited(table).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
    shas = Counter((r.doc_id, r.edited_sha256) for r in found)
    # A copy is followed by a copy, the last copy by the next document.
    assert shas[5, hashlib.sha256(b"five five five").hexdigest()] == 3
    assert shas[5, hashlib.sha256(b"five five four").hexdigest()] == 1
    assert shas[9, hashlib.sha256(b"nine nine ninfive f").hexdigest()] == 1
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


def test_edited_of_few_documents(spark):
    assert fingerprints.edited(spark.createDataFrame([], TEXTS)).collect() == []
    alone = fingerprints.edited(spark.createDataFrame([(1, "just one text", "", 1, "")], TEXTS)).collect()
    assert [r.edited_sha256 for r in alone] == [hashlib.sha256(b"just one te" [:9] + b"just").hexdigest()]
    assert [(r.near_next, r.doc_id) for r in alone] == [(1.0, 1)]


def words(draw, n):
    return " ".join("".join(draw.choices("abcdefghijklmnop", k=6)) for _ in range(n))


def shingles(text):
    size = fingerprints.SHINGLE
    return {text[i : i + size] for i in range(max(1, len(text) - size + 1))} if text else set()


def test_likeness_is_close_to_the_true_share():
    draw = random.Random(4)
    for n in (5, 30, 300, 3000):
        for kept in (0.1, 0.5, 0.67, 0.9):
            a = words(draw, n)
            b = a[: int(len(a) * kept)] + words(draw, n)
            x, y = shingles(a), shingles(b)
            true = len(x & y) / min(len(x), len(y))
            assert abs(fingerprints.likeness(fingerprints.sketch(a), fingerprints.sketch(b)) - true) < 0.2, (n, kept)
        assert fingerprints.likeness(fingerprints.sketch(a), fingerprints.sketch(a)) == 1
        assert fingerprints.likeness(fingerprints.sketch(a), fingerprints.sketch(words(draw, n))) < 0.05


def test_containment_of_a_short_text_in_a_very_long_one():
    draw = random.Random(6)
    short = words(draw, 400)
    long = fingerprints.sketch(words(draw, 30000) + short + words(draw, 30000))
    assert fingerprints.containment(fingerprints.sketch(short), long) == 1
    assert fingerprints.containment(fingerprints.sketch(words(draw, 400)), long) < 0.05
    assert fingerprints.containment(long, fingerprints.sketch(short)) < 0.05


def test_fingerprint_edges():
    empty, one = fingerprints.sketch(""), fingerprints.sketch("a")
    assert fingerprints.to_text(empty) == "" and len(fingerprints.to_text(one)) == 12
    assert fingerprints.likeness(empty, empty) == 1 and fingerprints.likeness(empty, one) == 0
    kept = fingerprints.sketch("some text " * 50 + "and an end")
    assert fingerprints.from_text(fingerprints.to_text(kept)).tolist() == kept.tolist()


def test_merged_is_the_union(spark):
    draw = random.Random(8)
    texts = [(f"g{i % 3}", words(draw, draw.choice([3, 60, 4000]))) for i in range(12)] + [("g3", ""), ("g3", None), (None, "x")]
    table = spark.createDataFrame([(g, t) for g, t in texts], "fingerprint string, text string")
    table = fingerprints.fingerprints(table.withColumnRenamed("fingerprint", "group"), keep=["group"])
    found = {r["group"]: r.fingerprint for r in fingerprints.merged(table, "group").collect()}
    for group in {g for g, _ in texts}:
        every = [fingerprints.sketch(t or "") for g, t in texts if g == group]
        union = np.unique(np.concatenate(every))
        assert found[group] == fingerprints.to_text(fingerprints._normal(union)), group


def test_fingerprints_keep_any_column(spark):
    table = spark.createDataFrame([("same text", "k", "l")], "text string, __text string, text_ string")
    row = fingerprints.fingerprints(table, keep=["__text", "text_", "text"]).first()
    assert tuple(row) == ("k", "l", "same text", fingerprints.to_text(fingerprints.sketch("same text")))
