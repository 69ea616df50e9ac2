"""The text operators against brute force, on awkward rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

import public_tokenizers
from ledgerbrook.llm import bpe, decontaminate, jaccard_join, lm, quality, quotes, substring_dedup, suffix_dedup
from ledgerbrook.llm import tables, toxicity, url_filter
from ledgerbrook.llm.arrays import words_of, texts_of
from ledgerbrook.llm.repeats import Shape
from ledgerbrook.llm.tables import components

import pyarrow as pa

SCHEMA = "doc_id bigint, text string, key string, kept string, n_words string"


def sentence(draw, n, words=40):
    return " ".join(f"w{draw.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(3)
    long = sentence(draw, 3000, 900)
    passage = sentence(draw, 60)
    made = [
        None, "", "   \n\t", "one", "one two three four", "one two three four", "Ünïcode wörds x\x1cy é", long,
        "head " + long, long + " tail", passage, "a b " + passage + " c d", passage + " " + passage, "x " * 400, "aaaa" * 300,
    ]
    base = [sentence(draw, 80, 5000) for _ in range(6)]
    for text in base:
        for _ in range(5):
            words = text.split()
            for _ in range(draw.randrange(4)):
                words[draw.randrange(len(words))] = f"z{draw.randrange(50)}"
            made.append(" ".join(words))
    table = [(i, text, "clash", "clash", "clash") for i, text in enumerate(made)]
    return [*table, table[7], table[7], (None, made[7], "c", "c", "c"), (None, "nothing else", "c", "c", "c")]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def split(text, lower=False):
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def multiset(frame):
    return Counter(tuple(row) for row in frame.collect())


# ---- words and fingerprints


def test_words_of_slices():
    texts = [None, b"", b" a  b", b"c\x0bd\x1ce ", b"", b"longer-than-eight-bytes x"]
    words = words_of(texts_of(pa.array([None, *texts], pa.binary()).slice(1)))
    assert np.diff(words.first).tolist() == [0, 0, 2, 2, 0, 2]
    again = words_of(texts_of(pa.array([b"x d\x1ce longer-than-eight-bytes a"])))
    assert set(words.hash.tolist()) & set(again.hash.tolist()) == set(again.hash.tolist())


def test_components(spark):
    links = spark.createDataFrame([(9, 8), (8, 7), (7, 6), (1, 2), (5, 5), (3, 1)], "a bigint, b bigint")
    got = {row.node: row.component for row in components(links).collect()}
    assert got == {9: 6, 8: 6, 7: 6, 6: 6, 1: 1, 2: 1, 3: 1}
    assert components(links.limit(0)).count() == 0


# ---- 1


def brute_components(rows):
    sets = []
    for _, text, *_ in rows:
        words = split(text, lower=True)
        sets.append({tuple(words[i : i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set()))
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    least = {}
    for i, g in enumerate(group):
        if rows[i][0] is not None:
            least[g] = min(least.get(g, rows[i][0]), rows[i][0])
    return Counter((row[0], len(sets[i]), least.get(group[i])) for i, row in enumerate(rows))


@pytest.mark.parametrize("frequent, leaf", [(32, 4), (1, 2)])
def test_jaccard_components(monkeypatch, table, rows, frequent, leaf):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "LEAF", leaf)
    assert multiset(jaccard_join.jaccard_components(table)) == brute_components(rows)


def test_jaccard_clusters_around_missing_originals(spark):
    draw = random.Random(5)
    rows = []
    for family in range(3):
        base = sentence(draw, 120, 10_000).split()
        edits = [draw.randrange(120) for _ in range(12)]
        for _ in range(25):
            words = list(base)
            for at in draw.sample(edits, draw.randrange(3, 6)):
                words[at] = f"e{family}-{draw.randrange(3)}"
            rows.append((len(rows), " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert multiset(jaccard_join.jaccard_components(frame)) == brute_components(rows)


@pytest.mark.parametrize("earlier, many", [(8, 64), (1, 1)])
def test_near_copies_do_not_meet_in_every_region_they_share(spark, monkeypatch, earlier, many):
    made, met = [], jaccard_join._met

    def counted(*given):
        pairs = met(*given)
        made.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(jaccard_join, "_met", counted)
    monkeypatch.setattr(jaccard_join, "EARLIER", earlier)
    monkeypatch.setattr(jaccard_join, "MANY", many)
    monkeypatch.setattr(jaccard_join, "LEAF", 3)
    draw = random.Random(11)
    rows = []
    for _ in range(2):
        base = sentence(draw, 300, 10_000).split()
        for _ in range(30):
            words = list(base)
            for at in draw.sample(range(300), draw.randrange(2, 6)):
                words[at] = f"e{draw.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert multiset(jaccard_join.jaccard_components(frame)) == brute_components(rows)
    all_made, different = map(sum, zip(*made))
    assert different > 0
    if earlier == 8:
        assert all_made <= 4 * different


@pytest.mark.parametrize("frequent, pieces", [(3, 12), (1, 2)])
def test_frequent_shingles_are_counted_in_pieces(spark, monkeypatch, frequent, pieces):
    """All of them, over tasks and batches; behind the shuffle is a row per piece and task, not per shingle."""
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard_join, "PIECES", pieces)
    tables_of = []
    monkeypatch.setattr(jaccard_join, "bitmap", lambda table, hashed: tables_of.append(table))
    draw = random.Random(9)
    parts = [sentence(draw, 12, 1000) for _ in range(20)]
    texts = [" ".join(draw.choices(parts[: k % 20 + 1], k=3)) for k in range(60)] + [None, "", "one", *["x " * 30] * 9]
    frame = spark.createDataFrame([(None if t is None else t.encode(),) for t in texts], "text binary").repartition(4)
    jaccard_join._frequent(frame, 5)
    got = [row.place % 2**32 for row in tables_of[0].collect()]
    c = Counter()
    for text in texts:
        names = jaccard_join.shingles(pa.array([None if text is None else text.encode()], pa.binary()), 5).names
        assert len(names) <= jaccard_join.COUNTED_SHORT and len(set(names.tolist())) == len(names)
        c.update(x >> 31 for x in names.tolist())
    assert sorted(got) == sorted(x for x, n in c.items() if n > frequent) and got
    assert "Aggregate" not in tables_of[0]._jdf.queryExecution().toString()


def test_sets_of_many_texts_are_those_of_each():
    draw = random.Random(10)
    texts = [None, "", "a", "a b c d", "a b c d e", "x " * 50, *[sentence(draw, draw.randrange(300), 30) for _ in range(40)], ""]
    column = pa.array([None if t is None else t.encode() for t in texts], pa.binary())
    hot = np.random.default_rng(0).integers(-(2**62), 2**62, 1 << 18)
    sets = jaccard_join.shingles(column, 5)
    order, prints = jaccard_join._ordered(sets, hot), sets.prints()
    ends, n = sets.first.tolist(), sets.sizes().tolist()
    for i, text in enumerate(texts):
        words = split(text)
        names, own = sets.names[ends[i] : ends[i + 1]], order[ends[i] : ends[i + 1]]
        assert n[i] == len({tuple(words[k : k + 5]) for k in range(len(words) - 4)} or ({tuple(words)} if words else set()))
        alone = jaccard_join.shingles(column.slice(i, 1), 5)
        assert np.array_equal(names, alone.names) and prints[i] == alone.prints()[0]
        assert (np.diff(names.view(np.int64)) > 0).all() and (np.diff(own) > 0).all()
        assert sorted((own & np.int64(2**63 - 1)).tolist()) == names.tolist()
        assert np.array_equal(own >= 0, tables.in_bitmap(hot, (own & np.int64(2**63 - 1)).view(np.uint64) >> np.uint64(31)))


def test_the_join_gives_its_tables_back(spark, monkeypatch, tmp_path):
    names = iter(range(10**6))
    monkeypatch.setattr(tables, "new_shared_path", lambda spark, label: f"{tmp_path}/{label}-{next(names)}")
    draw = random.Random(8)
    base = [[f"w{draw.randrange(10**6)}" for _ in range(60)] for _ in range(30)]
    texts = [" ".join(words[:k] + [f"new{k}"] + words[k + 1 :]) for words in base for k in (3, 30, 58)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert jaccard_join.jaccard_components(frame).count() == len(texts)
    left = {str(p.name): spark.read.parquet(str(p)).count() for p in tmp_path.iterdir()}
    for label in ("sets", "nodes", "regions", "central", "close", "rest"):
        assert [n for name, n in left.items() if name.startswith(label)] and not any(
            n for name, n in left.items() if name.startswith(label)
        )


# ---- 3 and 4


def brute_repeats(sequences, window):
    seen = Counter(tuple(s[i : i + window]) for s in sequences for i in range(len(s) - window + 1))
    masks = []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - window + 1):
            if seen[tuple(s[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        masks.append(gone)
    return masks


@pytest.mark.parametrize("shape", [substring_dedup.SHAPE, Shape("word", 8, 4, 2)])
def test_substring_dedup(table, rows, shape):
    sequences = [split(row[1]) for row in rows]
    want = Counter()
    for row, words, gone in zip(rows, sequences, brute_repeats(sequences, shape.window)):
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        want[row[0], len(words), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    assert multiset(substring_dedup.remove_repeated_words(table, shape=shape, digests=True)) == want


@pytest.mark.parametrize("shape", [suffix_dedup.SHAPE, Shape("byte", 24, 10, 5)])
def test_suffix_dedup(table, rows, shape):
    sequences = [(row[1] or "").encode() for row in rows]
    want = Counter()
    for row, raw, gone in zip(rows, sequences, brute_repeats(sequences, shape.window)):
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        want[row[0], len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert multiset(suffix_dedup.remove_repeated_bytes(table, shape=shape, digests=True)) == want


def test_suffix_ranks_are_places_in_sorted_order(spark):
    assert suffix_dedup.rounds_of(suffix_dedup.SHAPE) == [26, 52]
    draw = random.Random(12)
    rows = [(i, draw.randrange(-3, 3), draw.randrange(-3, 3)) for i in range(60)]
    rows += [(60, 9, 9), (61, -9, 0)]
    table = tables.saved(spark.createDataFrame(rows, "key bigint, rank bigint, next bigint"), "suffixes")
    folder = table.inputFiles()[0].rsplit("/", 1)[0]
    got = {r.key: r.rank for r in suffix_dedup.reranked(table, "next").collect()}
    seen = Counter(row[1:] for row in rows)
    left = {key: (rank, ahead) for key, rank, ahead in rows if seen[rank, ahead] > 1}
    assert got.keys() == left.keys()
    for a in left:
        for b in left:
            assert (got[a] < got[b]) == (left[a] < left[b])
    assert spark.read.parquet(folder).count() == 0  # its space is given back


def test_suffix_dedup_with_a_full_bitmap(monkeypatch, table, rows):
    want = multiset(suffix_dedup.remove_repeated_bytes(table, digests=True))
    full = np.full(1 << (tables.BITMAP_BITS - 6), -1, np.int64)
    monkeypatch.setattr(suffix_dedup, "bitmap", lambda *_: full)
    assert multiset(suffix_dedup.remove_repeated_bytes(table, digests=True)) == want


# ---- 5


def test_leaks_with_substitutions(spark):
    draw = random.Random(9)
    items = [(i, sentence(draw, 30, 2000)) for i in range(5)] + [(5, None), (6, "too short")]
    words = items[2][1].split()
    words[7] = words[19] = "changed"
    fill = lambda: sentence(draw, 40, 3000)
    docs = [
        (1, fill() + " " + items[0][1].upper().replace(" ", ", ") + " " + fill(), "x"),
        (2, fill() + " " + " ".join(words), "x"),
        (3, fill(), "x"),
        (4, None, "x"),
        (5, "too short", "x"),
        (6, fill() + " " + " ".join(items[3][1].split()[:8]), "x"),
        (7, items[4][1], "x"),
        (7, items[4][1], "x"),
    ]
    table = spark.createDataFrame(docs, "doc_id bigint, text string, key string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): (r.n_overlap, r.n_equal) for r in decontaminate.leaks(table, benchmark).collect()}
    assert found == {(1, 0): (30, 30), (2, 2): (30, 28), (7, 4): (30, 30)}
    left = decontaminate.clean(table, benchmark)
    assert left.columns == table.columns
    assert sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 6]
    assert decontaminate.leaks(table.limit(0), benchmark).count() == 0
    assert decontaminate.clean(table, benchmark.limit(0)).count() == len(docs)


def test_leaks_of_short_items_changed_near_their_ends(spark):
    draw = random.Random(10)
    items, docs = [], []
    for i, (size, changed) in enumerate([(15, [3]), (18, [3, 16]), (14, [2]), (13, [1]), (11, [2]), (12, [12])]):
        words = [f"i{i}w{j}" for j in range(size)]
        items.append((i, " ".join(words)))
        for place in changed:
            words[place - 1] = "changed"
        docs.append((i, " ".join([sentence(draw, 30, 3000), *words, sentence(draw, 30, 3000)])))
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = decontaminate.leaks(table, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.item_id, r.n_overlap, r.n_equal, r.start) for r in found} == {
        (0, 0, 15, 14, 30), (1, 1, 18, 16, 30), (2, 2, 14, 13, 30), (3, 3, 13, 12, 30), (4, 4, 11, 10, 30), (5, 5, 12, 11, 30)
    }


def test_leaks_of_parts_and_of_split_copies(spark):
    draw = random.Random(11)
    words = [[f"i{i}w{j}" for j in range(size)] for i, size in enumerate([59, 200, 60, 33, 40])]
    split_copy = lambda w, at: [*w[:at], "added", *w[at : 2 * at], "more", *w[2 * at :]]
    weak = [w if i % 10 else "changed" for i, w in enumerate(words[4][5:18])]
    parts = [words[0][20:49], words[1][50:149], split_copy(words[2], 20), split_copy(words[3], 11), weak, words[4][:12]]
    docs = [(i, " ".join([sentence(draw, 30, 3000), *w, sentence(draw, 30, 3000)])) for i, w in enumerate(parts)]
    table = spark.createDataFrame(docs, "doc_id bigint, text string")
    benchmark = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(words)], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): (r.n_overlap, r.n_equal, r.start) for r in decontaminate.leaks(table, benchmark).collect()}
    assert found == {(0, 0): (29, 29, 30), (1, 1): (99, 99, 30), (2, 2): (60, 60, 30), (3, 3): (33, 33, 30)}


def test_longest_stretch():
    draw = np.random.default_rng(4)
    for _ in range(200):
        equal = draw.random(draw.integers(0, 30)) < 0.6
        ends = [(b - a, -a) for a in range(len(equal)) for b in range(a + 1, len(equal) + 1)
                if equal[a] and equal[b - 1] and 100 * equal[a:b].sum() >= decontaminate.EQUAL_PERCENT * (b - a)]
        a, b = decontaminate.longest(equal)
        assert (b - a, -a) == max(ends, default=(0, 0))


# ---- 6


def test_threads_without_quotes(spark):
    rows = [
        (1, 0, "user", "How do I sort?\nPlease help."),
        (1, 1, "assistant", "Use orderBy.\nOr sort."),
        (1, 2, "user", "> How do I  SORT?\nme too"),
        (1, 3, "user", "> Use orderBy.\n>> How do I sort?\nThanks!"),
        (1, 4, "user", "> nobody wrote this\nhello"),
        (1, 5, "user", "> Thanks!\nwelcome"),
        (2, 0, "user", "> Use orderBy.\nother conversation"),
        (2, 1, None, None),
    ]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = sorted(quotes.threads(table).collect(), key=lambda r: (r.conv_id, r.place))
    assert [(r.conv_id, r.turn, r.parent_turn, r.depth) for r in got] == [
        (1, 0, None, 0), (1, 2, 0, 1), (1, 1, None, 0), (1, 3, 1, 1), (1, 5, 3, 2), (1, 4, None, 0),
        (2, 0, None, 0), (2, 1, None, 0),
    ]
    assert got[3].content == "<|user|>\nThanks!\n" and got[-1].content == "<||>\n\n"
    assert quotes.threads(table.limit(0)).count() == 0


# ---- 7


def test_quotes_without_origin_stay(spark):
    rows = [(1, 0, "user", "First line\nsecond"), (1, 1, "user", "> from elsewhere\n> \nreply"),
            (1, 2, "user", "> first  LINE\n>\n> from elsewhere\nboth")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.turn: (r.parent_turn, r.content) for r in quotes.threads(table).collect()}
    assert got[1] == (None, "<|user|>\n> from elsewhere\n> \nreply\n")
    assert got[2] == (0, "<|user|>\n> from elsewhere\nboth\n")


def plain(line):
    marks = re.match(r"([ \t]*>)+", line)
    marks = marks.group() if marks else ""
    return marks.count(">"), " ".join(line[len(marks) :].split()).lower()


def pieces_of(text):
    """``level, first place, lines, words`` of the passages of a text."""
    out, last = [], (-1, "")
    for place, line in enumerate(text.split("\n")):
        now = plain(line)
        if now[1]:
            if now[0] != last[0] or not last[1]:
                out.append((now[0], place, []))
            out[-1][2].append(now[1])
        last = now
    return out


def brute_threads(rows):
    """``parent`` by (conv, turn), and ``linked`` places by (conv, turn, text)."""
    own = defaultdict(lambda: (set(), set()))
    runs = lambda words: {tuple(words[i : i + quotes.WINDOW]) for i in range(len(words) - quotes.WINDOW + 1)}
    for conv, turn, _, text in rows:
        for level, _, lines in pieces_of(text or ""):
            if not level and turn is not None:
                whole, parts = own[conv, turn]
                whole.update([" ".join(lines), *lines])
                parts.update(*(runs(x.split()) for x in [" ".join(lines), *lines]))

    def origin(conv, turn, body):
        if turn is None:
            return None
        before = sorted((t for c, t in own if c == conv and t < turn), reverse=True)
        words, parts = body.split(), Counter()
        names = [body] + [" ".join(words[i : i + quotes.WINDOW]) for i in range(len(words) - quotes.WINDOW + 1)]
        known = lambda t, name: name in own[conv, t][0] or tuple(name.split()) in own[conv, t][1]
        found = [next((t for t in before if known(t, name)), None) for name in names]
        if found[0] is not None:
            return found[0]
        if not found[1:] or None in found[1:]:
            return None
        parts = Counter(found[1:])
        return max(parts, key=lambda t: (parts[t], t))

    votes, linked = defaultdict(list), defaultdict(set)
    for conv, turn, text in {(c, t, x or "") for c, t, _, x in rows}:
        for level, first, lines in pieces_of(text):
            if level:
                whole = origin(conv, turn, " ".join(lines))
                each = [(i, origin(conv, turn, x) if whole is None else whole) for i, x in enumerate(lines)]
                for i, found in each:
                    if found is not None:
                        votes[conv, turn].append((found, level))
                        linked[conv, turn, text].add(first + i)
    parents = {}
    for key, cast in votes.items():
        n = Counter(t for t, _ in cast)
        parents[key] = min(n, key=lambda t: (min(lv for o, lv in cast if o == t), -n[t], -t))
    return parents, linked


@pytest.mark.parametrize("span", [1024, 3])
def test_threads_by_brute_force(spark, monkeypatch, span):
    monkeypatch.setattr(quotes, "SPAN", span)
    draw = random.Random(span)
    rows = []
    for conv in range(6):
        texts = []
        for turn in range(14):
            lines = [sentence(draw, draw.randrange(1, 14), 40) if draw.random() < 0.8 else "" for _ in range(4)]
            for _ in range(draw.randrange(3) if texts else 0):
                words = " ".join(x for x in draw.choice(texts).split("\n") if ">" not in x).split()
                start = draw.choice([0, draw.randrange(len(words) + 1)])
                words = words[start : start + draw.randrange(5, 40)]
                width = draw.randrange(3, 12)
                cut = [words[i : i + width] for i in range(0, len(words), width)]
                lines += [">" * draw.choice([1, 1, 2]) + " " + " ".join(x).upper() for x in cut] + draw.choice([[], [">"]])
                lines += draw.choice([["reply"], ["> never written before by any one at all here"], draw.choice(texts).split("\n")[:2]])
            texts.append("\n".join(lines))
            rows.append((conv, turn, "user", texts[-1]))
    rows += [rows[5], (*rows[9][:3], rows[20][3]), (0, None, "user", rows[3][3]), (None, 1, "user", rows[3][3]), (3, 99, None, None)]
    table = spark.createDataFrame([(*row, "x") for row in rows], "conv_id bigint, turn bigint, role string, text string, body string")
    got = quotes.threads(table).collect()
    parents, linked = brute_threads([row for row in rows if row[0] is not None])
    assert len(set(parents.values())) > 5 and any(len(x) > 3 for x in linked.values())

    def content(conv, turn, role, text):
        gone, lines = linked.get((conv, turn, text or ""), ()), (text or "").split("\n")
        keep = [x for i, x in enumerate(lines) if i not in gone and not (gone and plain(x)[0] and not plain(x)[1])]
        return f"<|{role or ''}|>\n" + "\n".join(keep).strip(" \t\n") + "\n"

    want = Counter((r[0], r[1], parents.get(r[:2]), content(*r)) for r in rows)
    assert Counter((r.conv_id, r.turn, r.parent_turn, r.content) for r in got) == want


def test_a_rewrapped_paragraph_finds_the_nearest_origin(spark):
    long = " ".join(f"word{i}" for i in range(24))
    quote = "\n".join("> " + " ".join(long.split()[i : i + 8]) for i in range(0, 24, 8))
    part = "> " + " ".join(long.split()[5:15])
    rows = [(1, 0, "user", long), (1, 1, "user", long), (1, 2, "user", quote + "\nyes"), (1, 3, "user", part + "\nno")]
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.turn: (r.parent_turn, r.content) for r in quotes.threads(table).collect()}
    assert got[2] == (1, "<|user|>\nyes\n") and got[3] == (1, "<|user|>\nno\n")


def test_url_rules_and_trees(spark):
    urls = [
        "https://a.example.org/es/1", "https://example.org/en/12", "https://x.ORG/en/1", "https://b.com/fr/2?x=1",
        "https://c.com/de/3#f", "https://d.com/en/4", "no scheme", None, "https://notorg/", "https://e.org",
    ]
    table = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls * 3)], "page_id bigint, url string, host string")
    got = {r.page_id: r for r in url_filter.judge(table, url_filter.RULES).collect()}
    assert len(got) == len(urls) * 3
    rules = [got[i].rule for i in range(len(urls))]
    assert rules == ["example.org/es/", "example.org/en/1", "org/", "com/fr/", "com/de/", None, None, None, None, None]
    assert [got[i].verdict for i in range(5)] == ["block", "block", "allow", "allow", "block"]
    assert (got[2].host, got[3].path, got[6].host, got[7].path, got[9].path) == ("x.org", "/fr/2", "", "", "")
    assert {got[i].verdict for i in range(5, 10)} <= {"allow", "block"}
    assert url_filter.judge(table.limit(0), url_filter.RULES).count() == 0
    assert {r.verdict for r in url_filter.judge(table, []).collect()} == {"allow"}


def test_url_suffix_shares_are_of_each_suffix(spark):
    draw = random.Random(5)
    rows = [(f"s{draw.randrange(900)}", float(draw.random() < 0.4)) for _ in range(3000)]
    got = url_filter.shares(spark.createDataFrame(rows, "file string, label double"), "file", 0.25).collect()
    n, k = Counter(x for x, _ in rows), Counter(x for x, label in rows if label)
    assert {r.file: round(r.file_share, 12) for r in got} == {x: round((k[x] + 1.25) / (n[x] + 5), 12) for x in n}


def test_urls_are_blocked_like_those_with_their_file_suffix(spark):
    rules = [url_filter.Rule("block", "xyz.net", "/"), url_filter.Rule("allow", "zyx.net", "/")]
    kinds = {"b": "xyz", "g": "zyx"}  # the hosts have the same letters: only the suffix tells
    urls = [f"https://{host}.net/p/{i}.{kind}{i % 300}" for i in range(3000) for kind, host in kinds.items()]
    asked = [f"https://yxz.net/p/{i + 1000}.{kind}{i}" for i in range(300) for kind in kinds]
    table = spark.createDataFrame([(i, u) for i, u in enumerate([*urls, *asked])], "page_id bigint, url string")
    got = {r.page_id: r for r in url_filter.judge(table, rules).collect()}
    for i, url in enumerate(asked, len(urls)):
        assert (got[i].rule, got[i].verdict) == (None, "block" if ".b" in url else "allow")


# ---- 8


def brute_quality(text):
    text = text or ""
    words = [w.decode() for w in split(text)]
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {i + k for i in range(len(words) - 7) for k in range(8) if windows[tuple(words[i : i + 8])] > 1}
    lines = [line for line in text.split("\n") if split(line)]
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def test_quality_measures(spark, table, rows):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    more = [(100, "a b. \n a b. \na b.\n\n \n" * 9, "", "", ""), (101, "<a> | b & c * #d % $e", "", "", "")]
    frame = table.unionByName(spark.createDataFrame(more, SCHEMA))
    got = multiset(quality.judge(frame).select("doc_id", *names))
    assert got == Counter((row[0], *brute_quality(row[1])) for row in [*rows, *more])


def test_quality_lines(spark):
    good = "This is a plain sentence of some words, and it ends well."
    bad = ["Home | About | News | Contact", "All rights reserved.", "BUY!! THIS!! NOW!!", "menu", "#a #b #c #d",
           "go go go go go go go go go go go"]
    text = "\n".join([good, *bad, "", good + " Twice."])
    frame = spark.createDataFrame([(1, text), (2, "\n".join(bad * 3))], "doc_id bigint, text string")
    got = {r.doc_id: r for r in quality.judge(frame).collect()}
    assert got[1].clean_text == "\n".join([good, "", good + " Twice."])
    assert not got[2].kept
    plan = quality.judge(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# ---- 9


def test_bpe_is_tiktoken(table, rows):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = bpe.encode(table, ranks, public_tokenizers.PATTERN, give=["n_tokens", "ids", "decoded"]).collect()
    want = Counter((row[0], *encoding.encode_ordinary(row[1] or "")) for row in rows)
    assert Counter((r.doc_id, *r.ids) for r in got) == want
    assert Counter(bytes(r.decoded) for r in got) == Counter((row[1] or "").encode() for row in rows)
    own = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    draw = random.Random(1)
    for _ in range(300):
        text = "".join(draw.choice("ab =é漢\n'sAé0") for _ in range(draw.choice([5, 60, 900])))
        assert list(bpe.unpack(own.encode(text))) == encoding.encode_ordinary(text)
    long = "ab" * 50_000
    assert list(bpe.unpack(own.encode(long))) == encoding.encode_ordinary(long)


# ---- 2 and 10


def test_toxicity_finds_held_out(spark):
    draw = random.Random(4)
    insults = ["gruntle", "snarfed", "blighty", "crudmun", "wastrel"]
    docs, labels = [], []
    for i in range(600):
        words = sentence(draw, 40, 300).split()
        toxic = i % 5 == 0
        if toxic:
            for word in draw.sample(insults, 3):
                words.insert(draw.randrange(40), word)
        docs.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    docs += [(600, None, "x"), (601, "", "x"), (None, "gruntle snarfed", "x")]
    table = spark.createDataFrame(docs, "doc_id bigint, text string, score string")
    known = spark.createDataFrame([*labels, (7000, None)], "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in toxicity.score(table, known).collect()}
    assert len(got) == len(docs)
    held = [i for i, _ in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert {i for i in range(600) if got[i].held_out} == set(held)
    assert sum(got[i].predicted == (i % 5 == 0) for i in held) >= 0.97 * len(held)
    assert got[600].predicted == got[601].predicted == 0 and not got[None].held_out
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    assert toxicity.score(table.limit(0), known).count() == 0
    assert {r.score for r in toxicity.score(table, known.limit(0)).collect()} == {0.0}


@pytest.mark.parametrize("held_words", [1 << 19, 30])
def test_lm_base_scores(monkeypatch, table, rows, held_words):
    monkeypatch.setattr(lm, "TABLE_WORDS", held_words)
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [[*split(row[1], lower=True), None] for row in rows]
    c = Counter(t for row, ts in zip(rows, tokens) if not out(row[0]) for t in ts)
    n, v = sum(c.values()), len(c)
    want = defaultdict(list)
    for row, ts in zip(rows, tokens):
        base = sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts)
        want[row[0]].append((out(row[0]), len(ts), sum(c[t] > 0 for t in ts), n, round(base, 6)))
    got = defaultdict(list)
    for r in lm.score(table).collect():
        got[r.doc_id].append((r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)))
        assert math.isfinite(r.score) and r.score < 0
    assert {k: sorted(x) for k, x in got.items()} == {k: sorted(x) for k, x in want.items()}


def test_lm_learns_from_a_few_texts(spark):
    cycle = [f"w{i}" for i in range(8)]
    texts = [(i, " ".join(cycle[(i + j) % 8] for j in range(120 + i))) for i in range(96)]
    got = lm.score(spark.createDataFrame(texts, "doc_id bigint, text string").repartition(1)).where("held_out").collect()
    assert len(got) >= 8 and sum(r.score for r in got) > 0.5 * sum(r.base_score for r in got)


def test_lm_gradients_and_carried_state():
    draw = np.random.default_rng(0)
    words = lm.Vocabulary(
        np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.ones(lm.RARE_CLASSES), np.ones(lm.PLACES), 9, 5
    )
    model = {name: value.astype(float) for name, value in lm.new_model(words).items()}
    ids = draw.integers(0, lm.PLACES + lm.RARE_CLASSES, (3, 5))
    live = np.arange(5) < np.array([[5], [4], [2]])
    state = draw.normal(0, 0.3, (3, lm.STATE))

    def loss():
        h, total = state, 0.0
        for t in range(5):
            total -= lm.log_likelihood(model, h, ids[:, t])[live[:, t]].sum()
            h = np.where(live[:, t, None], lm.step(model, h, ids[:, t])[0], h)
        return total

    grads, _ = lm.gradients(model, state, ids, live)
    for name in model:
        at = np.unravel_index(np.argmax(np.abs(grads[name])), grads[name].shape)
        kept = model[name][at]
        model[name][at] = kept + 1e-5
        up = loss()
        model[name][at] = kept - 1e-5
        down = loss()
        model[name][at] = kept
        assert math.isclose((up - down) / 2e-5, grads[name][at], rel_tol=1e-4, abs_tol=1e-6)
    # A text in one piece, whatever the windows.
    flat, first = ids.ravel() % lm.PLACES, np.array([0, 9, 9, 15])
    whole = lm.text_scores(model, flat, first)
    h, alone = np.zeros((1, lm.STATE)), 0.0
    for i in flat[:9]:
        alone += lm.log_likelihood(model, h, np.array([i]))[0]
        h = lm.step(model, h, np.array([i]))[0]
    assert math.isclose(whole[0], alone, rel_tol=1e-5) and whole[1] == 0


def test_lm_steps_side_by_side_are_the_unit():
    """The step that works in place is the plain one, also where a gate is shut; gradients fill what they are given."""
    draw = np.random.default_rng(5)
    words = lm.Vocabulary(
        np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.ones(lm.RARE_CLASSES), np.ones(lm.PLACES), 9, 5
    )
    model = lm.new_model(words)
    model["into"][:2] = [[-500] * (2 * lm.STATE) + [1] * lm.STATE, [500] * (2 * lm.STATE) + [1] * lm.STATE]
    ids = np.array([0, 1, 7, lm.PLACES + 3])
    state = draw.normal(0, 0.3, (4, lm.STATE)).astype(np.float32)
    unit = lm.Unit(model)
    given, sums, after = unit.given(ids[None])[0], np.empty((3 * lm.STATE, 4), np.float32), np.empty((lm.STATE, 4), np.float32)
    with np.errstate(all="raise", under="ignore"):
        unit.step(state.T.copy(), given, sums, after)
    with np.errstate(over="ignore"):
        want, keep, reset, inner, fresh = lm.step(model, state, ids)
    assert np.allclose(after.T, want, atol=1e-6) and np.allclose(sums[2 * lm.STATE :].T, inner, atol=1e-6)
    assert np.allclose(given.T, np.concatenate([keep, reset, fresh], axis=1), atol=1e-6)
    ids, live = draw.integers(0, lm.PLACES + lm.RARE_CLASSES, (4, 3)), np.ones((4, 3), bool)
    flat = np.zeros(sum(value.size for value in model.values()), np.float32)
    plain, _ = lm.gradients(model, state, ids, live)
    lm.gradients(model, state, ids, live, lm._shaped(flat, model))
    assert np.array_equal(flat, lm._flat(plain)) and flat.any()


def test_lm_updates_are_adam(monkeypatch):
    monkeypatch.setattr(lm, "ADAM_PART", 7)
    draw = np.random.default_rng(6)
    flat, grad = draw.normal(0, 1, 30).astype(np.float32), np.zeros(30, np.float32)
    want, mean, square = flat.astype(float), np.zeros(30), np.zeros(30)
    adam = lm.Adam(flat, grad)
    for i in range(1, 40):
        grad[:] = np.where(draw.random(30) < 0.5, draw.normal(0, 3, 30), 0)
        own = grad / 4.0
        mean, square = 0.9 * mean + 0.1 * own, 0.99 * square + 0.01 * own * own
        want -= lm.RATE * mean / (1 - 0.9**i) / (np.sqrt(square / (1 - 0.99**i)) + 1e-6)
        adam.update(1 / 4)
        assert not grad.any() and np.allclose(flat, want, atol=1e-4)


def test_lm_probabilities_sum_to_one():
    draw = np.random.default_rng(2)
    words = lm.Vocabulary(
        np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.ones(lm.RARE_CLASSES), np.ones(lm.PLACES), 9, 5
    )
    model = lm.new_model(words)
    everything = np.arange(lm.PLACES + lm.RARE_CLASSES)
    states = np.repeat(draw.normal(0, 1, (1, lm.STATE)).astype(np.float32), len(everything), axis=0)
    assert math.isclose(np.exp(lm.log_likelihood(model, states, everything)).sum(), 1, rel_tol=1e-4)


# ---- empty tables


def test_empty_tables(nothing):
    ranks = {bytes([i]): i for i in range(256)}
    assert jaccard_join.jaccard_components(nothing).count() == 0
    assert substring_dedup.remove_repeated_words(nothing).count() == 0
    assert suffix_dedup.remove_repeated_bytes(nothing).count() == 0
    assert quality.judge(nothing).count() == 0
    assert bpe.encode(nothing, ranks, public_tokenizers.PATTERN).count() == 0
    assert lm.score(nothing).count() == 0


def test_bpe_of_many_pieces_is_that_of_each():
    draw = random.Random(9)
    # A made-up vocabulary in which merges can give pairs of lower ranks, and many overlaps.
    tokens = list(dict.fromkeys("".join(draw.choices("ab", k=draw.choice([2, 2, 3, 3, 4, 5]))).encode() for _ in range(60)))
    draw.shuffle(tokens)
    ranks = {token: i for i, token in enumerate([*tokens, *(bytes([i]) for i in range(256))])}
    merger = bpe.Merger(ranks)
    pieces = ["".join(draw.choices("abc", k=draw.randrange(1, 40))).encode() for _ in range(400)] + [b"a" * 48, b"b"]
    assert [ids.tolist() for ids in merger.merge_all(pieces)] == [merger.merge(piece) for piece in pieces]
    alone = bpe.Merger({bytes([i]): i for i in range(256)})
    assert [ids.tolist() for ids in alone.merge_all([b"ab", b"c"])] == [[97, 98], [99]]


def test_bpe_forgets_and_learns_again(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoder = bpe.Encoder(ranks, public_tokenizers.PATTERN)
    known = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    draw = random.Random(1)
    for _ in range(4):
        texts = ["".join(draw.choices("abcdef ÜñÄ漢\n", k=draw.randrange(300))) for _ in range(20)] + ["", "x" * 5000]
        assert [bpe.unpack(p).tolist() for p in encoder.encode_all(texts)] == [known.encode_ordinary(t) for t in texts]


def test_bpe_keeps_any_column(spark):
    ranks = {bytes([i]): i for i in range(256)}
    table = spark.createDataFrame([("ab", "k", "l")], "text string, __text string, text_ string")
    out = bpe.encode(table, ranks, ".", keep=["__text", "text_", "text"], give=["n_tokens"])
    assert [tuple(r) for r in out.collect()] == [("k", "l", "ab", 2)]


@pytest.mark.parametrize("limit, clipped, want", [(4, 1 << 16, 4), (4, 2, 4), (30, 2, 22), (1, 1, 1)])
def test_lm_word_table_is_bounded(spark, monkeypatch, limit, clipped, want):
    """Equal counts, and counts beyond the largest that is told apart."""
    monkeypatch.setattr(lm, "TABLE_WORDS", limit)
    monkeypatch.setattr(lm, "CLIPPED", clipped)
    texts = spark.createDataFrame([(" ".join(f"w{i}" for i in range(21)),)] * 5, "text string")
    counted = lm.counts(texts.select(F.col("text").cast("binary").alias("text"))).cache()
    words = lm.vocabulary(counted)
    assert len(words.word) == want and words.types == 22 and words.tokens == 110
    assert lm.END in words.word


def test_quality_keeps_any_column(spark):
    names = ["__text", "__words", "__lines", "__all", "n_words", "_", "text"]
    table = spark.createDataFrame([tuple("abcdef") + ("word " * 30,)], names)
    row = quality.judge(table).first()
    assert [row[name] for name in names if name not in ("n_words", "text")] == ["a", "b", "c", "d", "f"] and row.n_words == 30
