"""op4, op6 and op9: exact ids, round trips, packing and rollups."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import bytebpe, packing, rollup
from millrace.llm import sentencepiece_viterbi as sp

from .conftest import MESSY

TEXTS = [t or "" for _, t, *_ in MESSY] + ["a" * 5000, " " * 5000 + "x", "don't I'LL 12ab³ ½", "\x1c\x85 　x", "é" * 50, "“q” – €"]


@pytest.mark.parametrize("k", range(len(TEXTS)))
def test_bpe_ids_are_those_of_the_library(k):
    b = bytebpe.load()
    assert b.ids(TEXTS[k]).tolist() == b.slow.encode(TEXTS[k], add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_bpe_ids_of_any_text(text):
    b = bytebpe.load()
    text = text.encode("utf-8", "ignore").decode()
    assert b.ids(text).tolist() == b.slow.encode(text, add_special_tokens=False).ids


def brute_viterbi(v, s):
    best, back = [0.0] + [None] * len(s), [None] * (len(s) + 1)
    for i in range(len(s)):
        for j in range(i + 1, min(len(s), i + v.longest) + 1):
            hit = v.pieces.get(s[i:j])
            if hit and (best[j] is None or best[i] + hit[1] > best[j]):
                best[j], back[j] = best[i] + hit[1], (i, hit[0])
        if s[i] not in v.pieces and (best[i + 1] is None or best[i] + v.floor > best[i + 1]):
            best[i + 1], back[i + 1] = best[i] + v.floor, (i, -1)
    ids, e = [], len(s)
    while e:
        i, piece = back[e]
        ids += [piece] if piece >= 0 else [v.byte_ids[b] for b in reversed(s[i:e].encode())]
        e = i
    return ids[::-1]


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="the in of ation 日👍xyzé\n\t", max_size=120), st.integers(1, 40))
def test_streaming_is_the_best_path(text, step):
    e = sp.load()
    marked = (" " + text).replace(" ", sp.MARK)
    want = brute_viterbi(e.vocab, marked)
    assert e.search(marked, step) == want
    if text:
        assert np.frombuffer(e.encode(text), "<u4").tolist() == want
    assert e.decode(e.encode(text)) == text.replace(sp.MARK, " ")


def test_window_is_bounded():
    e = sp.load()
    stream, ids = sp.StreamingViterbi(e.vocab), 0
    for _ in range(300):
        ids += len(stream.feed("thestationofthings▁of▁the▁" * 10))
        assert len(stream.text) - stream.root < 200
    assert ids and stream.widest < 200 and stream.scores <= e.vocab.longest + 1


letters = st.text(alphabet="ab▁", min_size=1, max_size=5)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(letters, st.integers(-9, -1), min_size=1, max_size=8), st.lists(st.text(alphabet="ab ", max_size=50), max_size=4), st.integers(1, 9))
def test_commits_fall_where_paths_meet(scores, texts, step):
    """Any vocabulary, marks within pieces too: the best path, and each commit as early as can be."""
    v = sp.Vocabulary({p: (k + 1, float(s)) for k, (p, s) in enumerate(sorted(scores.items()))}, {}, 0, [""] * 9)
    encoder = sp.Encoder(v)
    for text in texts:
        marked = sp.MARK + text.replace(" ", sp.MARK)
        want = [0 if i < 0 else i for i in brute_unknown(v, marked)]
        stream, ids = sp.StreamingViterbi(v, marked), []
        for at in range(1, len(marked) + 1):
            ids += stream.advance(at)
            assert stream.root == last_meeting(stream), (marked, at)
            assert stream.scores <= v.longest + 1
        assert ids == want == encoder.search(marked, step)
        if text:
            assert np.frombuffer(encoder.encode(text), "<u4").tolist() == want


def brute_unknown(v, s):
    best, back = [0.0] + [None] * len(s), [None] * (len(s) + 1)
    for i in range(len(s)):
        for j in range(i + 1, min(len(s), i + v.longest) + 1):
            hit = v.pieces.get(s[i:j])
            if hit and (best[j] is None or best[i] + hit[1] > best[j]):
                best[j], back[j] = best[i] + hit[1], (i, hit[0])
        if s[i] not in v.pieces and (best[i + 1] is None or best[i] + v.floor > best[i + 1]):
            best[i + 1], back[i + 1] = best[i] + v.floor, (i, -1)
    ids, e = [], len(s)
    while e:
        i, piece = back[e]
        ids.append(piece)
        e = i
    return ids[::-1]


def last_meeting(stream):
    """The last boundary on the paths to all boundaries that are yet to be extended."""
    paths = []
    for e in range(stream.at, stream.reach + 1):
        if stream.best[e] == sp._NONE:
            continue
        path = [e]
        while path[-1] > stream.root:
            path.append(stream.back[path[-1]])
        paths.append(set(path))
    return max(set.intersection(*paths))


def test_the_table_holds_what_the_search_committed():
    e = sp.Encoder(sp.load().vocab)
    e.encode("the station of the station")
    assert set(e) == {"▁the", "▁station", "▁of"}  # the text's end is no place to learn from
    for stretch, ids in e.items():
        assert np.frombuffer(ids, "<u4").tolist() == e.search(stretch + "▁x")[: len(ids) // 4]


def test_commits_without_word_cuts():
    """Pieces that overlap everywhere: paths meet only by their back-pointers."""
    v = sp.Vocabulary({"ab": (1, -1.0), "ba": (2, -1.1), "a": (3, -3.0), "b": (4, -3.0), "bab": (5, -1.5)}, {}, 0, [""] * 6)
    assert sp.Encoder(v).search("ab" * 500, 7) == brute_viterbi(v, "ab" * 500)


def test_encode_decode_documents(documents, messy, no_docs):
    for df in (documents, messy):
        out = sp.round_trips(df).collect()
        assert len(out) == df.count() and all(r["exact"] for r in out)
    assert sp.round_trips(no_docs).count() == 0
    encoded = sp.encode_documents(messy, keep=["doc_id", "score"])
    assert encoded.columns == ["doc_id", "score", "ids"]
    texts = sorted(r["text"] for r in sp.decode_documents(encoded).collect())
    assert texts == sorted((t or "").replace(sp.MARK, " ") for _, t, *_ in MESSY)
    e = sp.load()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in sp.round_trips(documents).collect():
        ids = e.encode(texts[r["doc_id"]])
        assert (r["n_ids"], r["ids_crc32"]) == (len(ids) // 4, zlib.crc32(ids))


def check_packing(df, capacity=1024, **options):
    b = bytebpe.load()
    rows = packing.pack_documents(df, capacity=capacity, **options).collect()
    got, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids)
        got[r["doc_id"]].append((r["start"], ids.tolist(), r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], len(ids)))
    want = defaultdict(list)
    for r in df.collect():
        want[r["doc_id"]].append(b.ids(r["text"] or "").tolist() + [0])
    assert set(got) == set(want)
    for i, texts in want.items():
        pieces = sorted(got[i])
        assert sum(len(x[1]) for x in pieces) == sum(map(len, texts))
        if len(texts) == 1:
            assert [t for p in pieces for t in p[1]] == texts[0] and {p[2] for p in pieces} == {len(texts[0])}
            assert [p[0] for p in pieces] == np.cumsum([0] + [len(p[1]) for p in pieces])[:-1].tolist()
    padding = total = 0
    for pieces in sequences.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding == 0 and total == sum(len(t) for texts in want.values() for t in texts)


def test_packing(documents, messy, no_docs):
    check_packing(documents)
    check_packing(messy)
    check_packing(messy, capacity=64, most_open=3)
    assert packing.pack_documents(no_docs).count() == 0
    digests = packing.piece_digests(packing.pack_documents(documents)).first()
    assert 0 <= digests["ids_crc32"] < 1 << 32 and digests["length"] > 0


def test_sum_of_squares_choice():
    """The level chosen leaves the least sum of squares, over random states."""
    rng = random.Random(4)
    p = packing.SumOfSquares(32, lambda pieces: None, most_open=10**6)
    for _ in range(2000):
        size = rng.randrange(1, 32)
        def after(h, size=size):
            n = p.count.copy()
            if h:
                n[h] -= 1
            if h + size < 32:
                n[h + size] += 1
            return int((n[1:32] ** 2).sum())
        allowed = [h for h in range(0, 33 - size) if h == 0 or p.count[h]]
        assert after(p.level_for(size)) == min(map(after, allowed))
        p.place((0, 0, np.zeros(size, "<u4"), size))


def test_the_rule_places_all_but_the_last_windows():
    """At most ``most_open`` windows are left at the end; whole, if they fit, are pieces that are placed."""
    rng = random.Random(7)
    for most in (1, 3, 32):
        out = []
        p = packing.SumOfSquares(64, out.append, most_open=most)
        for k in range(3000):
            size = rng.randrange(1, 64)
            fits = p.n_open < most or any(p.count[h] for h in range(1, 65 - size))
            before = sum(map(len, out)) + sum(len(x) for level in p.open for x in level)
            p.add(k, np.zeros(size, "<u4"))
            pieces = sum(map(len, out)) + sum(len(x) for level in p.open for x in level) - before
            assert p.n_open <= most and (pieces == 1) == fits
        p.close()
        assert p.drained < 64 * most and p.drained < 0.05 * p.placed


def test_rollup_totals(spark, documents, messy):
    b = bytebpe.load()
    for df in (documents, messy):
        want, seen = defaultdict(lambda: np.zeros(3, int)), set()
        for r in sorted(df.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)):
            text = r["text"] or ""
            if text not in seen:
                want[r["source"], r["lang"], "byte-bpe-50k"] += [1, len(b.ids(text)), len(text)]
            seen.add(text)
        got = {(r["source"], r["lang"], r["version"]): [r["n_docs"], r["n_tokens"], r["n_chars"]] for r in rollup.corpus_rollup(df).collect()}
        assert sum(v[0] for v in got.values()) == len(seen)
        if df is documents:
            assert got == {k: v.tolist() for k, v in want.items()}


def test_batches_commit_once(spark, tmp_path, no_docs):
    t = rollup.TokenRollup(spark, str(tmp_path / "r"))
    assert t.totals().count() == 0
    docs = spark.createDataFrame([("a", "en", 5, 20), ("a", "en", 7, 30), (None, None, None, 3)], "s string, l string, t long, c long")
    img, none = rollup.image("s", "l", "v1", "t", "c"), F.lit(None).cast(rollup._image_type())
    inserts = docs.select(none.alias("before"), img.alias("after"))
    assert t.commit("one", inserts) and not t.commit("one", inserts)
    def sums():
        return {(r["source"], r["version"]): (r["docs"], r["tokens"], r["chars"]) for r in t.totals().collect()}
    assert sums() == {("a", "v1"): (2, 12, 50), (None, "v1"): (1, 0, 3)}
    new = rollup.image("s", "l", "v2", "t", "c")
    t.commit("two", docs.where("s = 'a'").select(img.alias("before"), new.alias("after")))
    assert sums() == {("a", "v2"): (2, 12, 50), (None, "v1"): (1, 0, 3)}
    t.commit("three", docs.where("t = 5").select(new.alias("before"), none.alias("after")))
    t.compact()
    assert sorted(r["id"] for r in t.batches().collect()) == ["one", "three", "two"] and not t.commit("two", inserts)
    assert sums() == {("a", "v2"): (1, 7, 30), (None, "v1"): (1, 0, 3)}
    assert rollup.corpus_rollup(no_docs).count() == 0
    with pytest.raises(ValueError):
        t.commit("../x", inserts)


class Lost(Exception):
    """The driver is lost."""


@pytest.mark.parametrize("survives", range(7))
def test_a_driver_lost_in_compact_loses_nothing(spark, tmp_path, survives):
    """After any number of renames and deletes: totals stay, no batch counts or commits twice."""
    docs = spark.createDataFrame([("a", "en", 5, 20), ("b", "en", 7, 30)], "s string, l string, t long, c long")
    img, none = rollup.image("s", "l", "v1", "t", "c"), F.lit(None).cast(rollup._image_type())
    inserts = docs.select(none.alias("before"), img.alias("after"))

    def sums(t):
        return {r["source"]: (r["docs"], r["tokens"], r["chars"]) for r in t.totals().collect()}

    path = str(tmp_path / "r")
    t = rollup.TokenRollup(spark, path)
    t.commit("zero", inserts)
    t.compact()
    t.commit("one", inserts)
    t.commit("two", inserts)
    steps = [survives]

    def step(act):
        def run(*args):
            if steps[0] == 0:
                raise Lost
            steps[0] -= 1
            act(*args)
        return run

    t._rename, t._delete = step(t._rename), step(t._delete)
    try:
        t.compact()
        assert survives >= 4
    except Lost:
        assert survives < 4
    t = rollup.TokenRollup(spark, path)
    want = {"a": (3, 15, 60), "b": (3, 21, 90)}
    assert sums(t) == want and not any(t.commit(i, inserts) for i in ("zero", "one", "two"))
    assert sorted(r["id"] for r in t.batches().collect()) == ["one", "two", "zero"]
    t.compact()
    assert sums(t) == want and t.commit("three", inserts)
    assert sums(t)["a"] == (4, 20, 80)


def test_of_two_writers_one_wins(spark, tmp_path, monkeypatch):
    """The second passes the check for the id, but finds the batch there when it renames."""
    docs = spark.createDataFrame([("a", "en", 5, 20)], "s string, l string, t long, c long")
    inserts = docs.select(F.lit(None).cast(rollup._image_type()).alias("before"), rollup.image("s", "l", "v1", "t", "c").alias("after"))
    t, late = (rollup.TokenRollup(spark, str(tmp_path / "r")) for _ in range(2))
    assert t.commit("one", inserts)
    monkeypatch.setattr(late, "committed", lambda i: False)
    assert not late.commit("one", inserts)
    assert [r["docs"] for r in t.totals().collect()] == [1]
