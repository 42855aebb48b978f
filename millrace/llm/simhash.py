"""SimHash near-duplicates by the generalised pigeonhole principle.

A document's 64-bit fingerprint is the bitwise majority over the XXH64 values of its
word shingles. Two fingerprints link at ``radius`` or fewer differing bits. To find all
links without comparing all pairs, the 64 bits are dealt into m parts and each part i
gets a threshold t_i >= -1 with sum(t_i) = radius - m + 1. By the generalised pigeonhole
principle, a pair within ``radius`` is within t_i on part i for at least one i (-1: the
part is not searched). Correlated bits are put in one part, where they waste least, and
a dynamic program allots the thresholds by estimated candidate and probe counts. The
plan rests on a bounded sample and moves only the cost: any plan finds every link.

Equal texts are collapsed to their fingerprint before probing. As a fingerprint has at
most C(64,1) + C(64,2) = 2,080 other values within two bits, links stay linear in the
number of distinct fingerprints, however large a group of copies is. Probe and check are
one equi-join on (part, key), which Spark can spill and, when skewed, split.

``keep_similar`` asks for texts whose sets of word shingles are alike to a Jaccard similarity.
Two sets alike to s have fingerprints that differ in about arccos(2s / (1 + s)) / pi of
their bits (15 % for 0.8), too many for 64 bits to tell apart from chance. So there the
fingerprint is wide: as many parts as it takes for a pair at the least similarity to be
within the threshold of one of them with probability ``RECALL``, each of as many bits as
keep chance meetings rare among all texts. The dynamic program allots the thresholds, now
of -1 (a part whose candidates are many is not searched), 0 or 1, under the same sum. A
threshold of 1 is searched by a key for each bit of the part, without that bit. Every
candidate is verified by the sets themselves, so that none below the similarity links.
What is wanted are components, so within a key's sets each is first compared with the one
that meets most others, and pairs are compared only where their sets are not yet in one
component: a large group of near copies costs a comparison a set and not a pair. Those
pairs are held to their sizes, 512 bits of the fingerprint and a parity bound in the join
itself.

Defined results: a null text counts as empty; a text without words has fingerprint zero
and links like any other; repeated rows each give a row, in one component; a null id is
passed through and never a component's id, unless all its ids are null; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from fractions import Fraction
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop_files_of, in_few_parts, materialize, packed, release
from .components import connected_components
from .shingle_sets import CELLS, MORE_CELLS, SEED, checked, parity, shingle_set

#: Fingerprints in the sample on which the plan of the search rests.
PLAN_SAMPLE = 3000
#: What a shuffled row costs, in candidate comparisons.
ROW_COST = 20.0
_CHUNK = 1 << 16
#: The least share of pairs at the similarity asked for that a wide fingerprint finds.
RECALL = 0.98
#: Bits of a part beyond the logarithm of the number of sets.
SPARE_BITS = 2
#: Words of the wide fingerprint by which pairs are compared where they meet.
COMPARED_WORDS = 8


def fingerprint(text: str | None, words: int = 3) -> int:
    """The signed 64-bit fingerprint of a text: A-Z lowered, ASCII white space parts words."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return 0
    if len(w) < words:
        w, words = [b" ".join(w)], 1
    n = len(w) - words + 1
    votes = np.zeros(64, dtype=np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, n, _CHUNK):
        part = w[at : at + _CHUNK + words - 1]
        shingles = part if words == 1 else map(join, zip(*(part[k:] for k in range(words)), strict=False))
        h = np.fromiter((digest(s, SEED) for s in shingles), dtype="<u8")
        votes += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > n, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, columns: list[Column], text: str = "text", words: int = 3) -> DataFrame:
    """``columns`` of ``docs`` and ``_fp``, the fingerprint of its text."""
    kept = docs.select(*columns, F.col(text).cast("string").alias("_body"))

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("_body")
            fps = pa.array([fingerprint(x.as_py(), words) for x in batch.column(at)], pa.int64())
            names = [f.name for k, f in enumerate(batch.schema) if k != at]
            yield pa.RecordBatch.from_arrays([batch.column(n) for n in names] + [fps], names=[*names, "_fp"])
        release()

    schema = T.StructType([*kept.drop("_body").schema.fields, T.StructField("_fp", T.LongType())])
    return kept.mapInArrow(run, schema)


def _parts(bits: np.ndarray, m: int) -> list[list[int]]:
    """Deal the bits (columns) into m parts of near-equal size, correlated bits together."""
    centred = bits - bits.mean(axis=0)
    size = np.sqrt((centred**2).sum(axis=0))
    size[size == 0] = 1
    corr = np.abs((centred / size).T @ (centred / size))
    np.fill_diagonal(corr, 0)
    left, parts = set(range(bits.shape[1])), []
    for k in range(m):
        want = len(left) // (m - k)
        start = max(left, key=lambda b: (corr[b, sorted(left)].max(), -b))
        part = [start]
        left.remove(start)
        while len(part) < want:
            best = max(left, key=lambda b: (corr[b, part].sum(), -b))
            part.append(best)
            left.remove(best)
        parts.append(sorted(part))
    return parts


def _ball(width: int, t: int) -> int:
    return sum(1 for r in range(t + 1) for _ in combinations(range(width), r))


def plan_search(sample: list[int], total: int, radius: int) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the parts to search, cheapest by estimate."""
    fps = np.array(sample or [0], dtype=np.int64)
    bits = np.unpackbits(fps.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
    s = len(fps)
    same = bits.mean(axis=0) ** 2 + (1 - bits.mean(axis=0)) ** 2
    best: tuple[float, list[tuple[list[int], int]]] = (np.inf, [])
    for m in range(1, radius + 2):
        parts = _parts(bits, m)
        cost = []
        for part in parts:
            x = bits[:, part]
            apart = x.sum(axis=1)[:, None] + x.sum(axis=1)[None, :] - 2 * x @ x.T
            row = {-1: 0.0}
            for t in range(radius + 1):
                seen = ((apart <= t).sum() - s) / max(1, s * (s - 1))
                even = float(np.prod(same[part])) * _ball(len(part), t)
                row[t] = ROW_COST * total * (1 + (_ball(len(part), t) if t else 0)) + max(seen, even) * total * total / 2
            cost.append(row)
        # table[sum of thresholds] = (cost, thresholds)
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for row in cost:
            new: dict[int, tuple[float, list[int]]] = {}
            for have, (c, ts) in table.items():
                for t, more in row.items():
                    if have + t not in new or c + more < new[have + t][0]:
                        new[have + t] = (c + more, [*ts, t])
            table = new
        c, ts = table[radius - m + 1]
        if c < best[0]:
            best = (c, list(zip(parts, ts, strict=True)))
    return [(part, t) for part, t in best[1] if t >= 0]


def _signed(bits) -> int:
    v = sum(1 << b for b in bits)
    return v - (1 << 64) if v >= 1 << 63 else v


def drawn(rows: DataFrame, total: int, n: int) -> DataFrame:
    """About ``n`` of ``total`` distinct ``_fp``, by their hash: as many go to the driver from however many tasks."""
    cut = min(1.0, n / max(1, total)) * (1 << 30)
    return rows.where(F.pmod(F.xxhash64("_fp"), F.lit(1 << 30)) < cut).dropDuplicates(["_fp"])


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """All pairs ``a < b`` of distinct values of ``fps._fp`` within ``radius`` bits."""
    total = fps.count()
    sample = [r[0] for r in drawn(fps, total, PLAN_SAMPLE).collect()]
    plan = plan_search(sorted(sample), total, radius)
    index, probe = [], []
    for k, (part, t) in enumerate(plan):
        mask = _signed(part)
        index.append(F.struct(F.lit(k).alias("part"), F.col("_fp").bitwiseAND(F.lit(mask)).alias("key")))
        for r in range(t + 1):
            for flip in combinations(part, r):
                probe.append(F.struct(F.lit(k).alias("part"), F.col("_fp").bitwiseAND(F.lit(mask)).bitwiseXOR(F.lit(_signed(flip))).alias("key")))
    a = fps.select(F.col("_fp").alias("a"), F.explode(F.array(*index)).alias("s")).select("a", "s.*")
    b = fps.select(F.col("_fp").alias("b"), F.explode(F.array(*probe)).alias("s")).select("b", "s.*")
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    joined = a.alias("x").join(b.alias("y"), (F.col("x.part") == F.col("y.part")) & (F.col("x.key") == F.col("y.key")) & near)
    return joined.select("a", "b")


def groups(marked: DataFrame, radius: int = 2) -> DataFrame:
    """``_fp`` and ``_root`` (a fingerprint of its component) for each distinct ``_fp``."""
    fps = materialize(marked.select("_fp").distinct(), "fingerprints", narrow=True)
    found = connected_components(links(fps, radius), "a", "b")
    return fps.join(found.withColumnRenamed("node", "_fp"), "_fp", "left").select("_fp", F.coalesce("root", "_fp").alias("_root"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", radius: int = 2, words: int = 3) -> DataFrame:
    """One row per document: ``id_col``, ``fingerprint`` (hex) and ``component_id``."""
    marked = materialize(with_fingerprint(docs, [F.col(id_col).alias("_id")], text, words), "simhash")
    root = groups(marked, radius)
    least = marked.groupBy("_fp").agg(F.min("_id").alias("_least"))
    known = root.join(least, "_fp")
    ids = known.groupBy("_root").agg(F.min("_least").alias("_component"))
    by_fp = materialize(known.join(ids, "_root").select("_fp", "_component"), "components", narrow=True)
    return in_few_parts(marked.join(by_fp, "_fp")).select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_component").alias("component_id"),
    )


def row_key(id_col: str, text: str) -> Column:
    """A key of id and text that is never null, so that a join and a last step share an exchange."""
    ident = F.coalesce(F.col(id_col).cast("string"), F.lit("-"))
    return F.sha2(F.concat(ident, F.lit("|"), F.coalesce(F.col(text), F.lit(""))), 256)


def kept_rows(docs: DataFrame, marked: DataFrame, roots: DataFrame, *, id_col: str, text: str) -> DataFrame:
    """``docs`` with one row of each ``_root``: that of the least id, then text hash.

    ``marked`` has ``_id``, ``_key`` (the row's key) and ``_fp``, ``roots`` ``_fp`` and ``_root``.
    Texts are shuffled once, to meet the kept keys; of equal rows one stays, as of rows
    of one id and text.
    """
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id"), F.col("_key")))
    kept = (
        marked.groupBy("_fp")
        .agg(first.alias("k"))
        .join(roots, "_fp")
        .groupBy("_root")
        .agg(F.min("k").alias("k"))
        .select(F.col("k._key").alias("_key"))
    )
    here = docs.select(packed(docs).alias("_doc"), row_key(id_col, text).alias("_key"))
    return here.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).select("_doc.*")


def wide_votes(shingles: np.ndarray, words: int) -> np.ndarray:
    """A set's fingerprint of ``words`` 64-bit words: bitwise majorities of as many hashes of each shingle."""
    if not len(shingles):
        return np.zeros(words, dtype="<i8")
    votes = np.zeros((words, 64), dtype=np.int64)
    step = np.uint64(0x9E3779B97F4A7C15)
    salts = np.arange(1, words + 1, dtype=np.uint64) * step
    for at in range(0, len(shingles), 255):  # so that the sums below fit a byte
        h = shingles[at : at + 255].view("<u8")[:, None] + salts
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        h ^= h >> np.uint64(31)
        bits = np.unpackbits(h.view(np.uint8).reshape(len(h), -1), axis=1, bitorder="little")
        votes += np.add.reduce(bits, axis=0, dtype=np.uint8).reshape(words, 64)
    return np.packbits(2 * votes > len(shingles), axis=1, bitorder="little").view("<i8").ravel()


def with_shingles(docs: DataFrame, columns: list[Column], text: str, words: int, wide: int) -> DataFrame:
    """``columns`` of ``docs``, ``_fp`` (its shingle set's hash), ``_n``, ``_wide``, two sketches and ``_shingles``."""
    kept = docs.select(*columns, F.col(text).cast("string").alias("_body"))
    longs = T.ArrayType(T.LongType())
    more = [T.StructField("_fp", T.LongType()), T.StructField("_n", T.LongType()), *[T.StructField(n, longs) for n in ("_wide", "_parity", "_more_parity", "_shingles")]]

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("_body")
            sets = [shingle_set(x.as_py(), words) for x in batch.column(at)]
            fps = pa.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], pa.uint64()).view(pa.int64())
            ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
            lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([*sets, np.zeros(0, dtype="<i8")]), pa.int64()))
            made = [[wide_votes(s, wide) for s in sets], *[[parity(s, n) for s in sets] for n in (CELLS, MORE_CELLS)]]
            names = [f.name for k, f in enumerate(batch.schema) if k != at]
            columns = [batch.column(n) for n in names]
            columns += [fps, pa.array(list(map(len, sets)), pa.int64()), *[pa.array(m, pa.list_(pa.int64())) for m in made], lists]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, *[f.name for f in more]])
        release()

    return kept.mapInArrow(run, T.StructType([*kept.drop("_body").schema.fields, *more]))


def wide_shape(total: int, similarity: float, recall: float = RECALL) -> tuple[int, int]:
    """(parts, bits of each) that find pairs of the similarity among ``total`` sets."""
    width = max(8, math.ceil(math.log2(max(2, total))) + SPARE_BITS)
    differ = math.acos(2 * similarity / (1 + similarity)) / math.pi
    meets = (1 - differ) ** width
    return (1 if meets >= recall else math.ceil(math.log(1 - recall) / math.log(1 - meets))), width


def plan_wide(sample: np.ndarray, total: int, parts: int, width: int) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the parts to search: correlated bits together, thresholds by dynamic program."""
    bits = np.unpackbits(np.ascontiguousarray(sample).view(np.uint8).reshape(len(sample), -1), axis=1, bitorder="little")[:, : parts * width].astype(np.float32)
    s, dealt = len(bits), []
    for at in range(0, parts * width, 4 * width):  # by groups of a few parts
        group = list(range(at, min(at + 4 * width, parts * width)))
        dealt += [[group[b] for b in part] for part in _parts(bits[:, group], len(group) // width)]
    table: dict[int, tuple[float, tuple[int, ...]]] = {0: (0.0, ())}  # sum of (threshold + 1) to cost, thresholds
    for part in dealt:
        x = bits[:, part]
        apart = x.sum(axis=1)[:, None] + x.sum(axis=1)[None, :] - 2 * x @ x.T
        cost = [0.0]
        for t in (0, 1):
            seen = ((apart < t + 0.5).sum() - s) / max(1, s * (s - 1))
            cost.append(ROW_COST * total * (width if t else 1) + max(seen, _ball(width, t) / 2.0**width) * total * total / 2)
        new: dict[int, tuple[float, tuple[int, ...]]] = {}
        for have, (c, ts) in table.items():
            for up, more in enumerate(cost):
                if have + up <= parts and (have + up not in new or c + more < new[have + up][0]):
                    new[have + up] = (c + more, (*ts, up - 1))
        table = new
    return [(part, t) for part, t in zip(dealt, table[parts][1], strict=True) if t >= 0]


def wide_keys(marked: DataFrame, plan: list[tuple[list[int], int]]) -> DataFrame:
    """``token`` and ``_fp``: the keys of each set's parts, for a threshold of 1 one without each bit."""

    def run(batches):
        for batch in batches:
            ids = batch.column("_fp").to_numpy(zero_copy_only=False)
            if not len(ids):
                continue
            words = batch.column("_wide").flatten().to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(words.view(np.uint8).reshape(len(ids), -1), axis=1, bitorder="little")
            tokens, number = [], 0
            for part, t in plan:
                for without in part if t else [None]:
                    some = bits[:, [b for b in part if b != without]]
                    raw = np.zeros((len(ids), 8 * -(-some.shape[1] // 64)), dtype=np.uint8)
                    key = np.packbits(some, axis=1, bitorder="little")
                    raw[:, : key.shape[1]] = key
                    h = np.full(len(ids), (number + 1) << 48, dtype=np.uint64)  # apart from all words' low bits
                    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
                    for word in raw.view("<u8").T:
                        h = (h ^ word) * np.uint64(0x9E3779B97F4A7C15)
                        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                    tokens.append((h ^ (h >> np.uint64(32))).view("<i8"))
                    number += 1
            columns = [np.concatenate(tokens), np.tile(ids, len(tokens))]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["token", "_fp"])
        release()

    return marked.select("_fp", "_wide").mapInArrow(run, "token long, _fp long")


def similar(marked: DataFrame, total: int, parts: int, width: int, similarity: float) -> DataFrame:
    """Pairs ``a``, ``b`` of ``_fp`` that are alike enough, and join all sets that are found alike."""
    like = Fraction(str(similarity))
    sketch = materialize(marked.select("_fp", "_n", "_parity").dropDuplicates(["_fp"]), "sketch", narrow=True)
    wide = marked.select("_fp", "_wide").dropDuplicates(["_fp"])
    rows = drawn(marked.select("_fp", "_wide"), total, PLAN_SAMPLE // 3).collect()
    sample = np.array(sorted({tuple(r["_wide"]) for r in rows}) or [(0,) * (-(-parts * width // 64))], dtype="<i8")
    # One exchange of the keys serves both sides of the join.
    keys = wide_keys(wide, plan_wide(sample, total, parts, width)).repartition("token")
    sizes = keys.groupBy("token").agg(F.count("*").alias("size")).where("size > 1")
    shared = materialize(keys.join(sizes, "token"), "shared", narrow=True)
    # The set that meets most others stands for a key's sets.
    met = shared.groupBy("_fp").agg(F.sum("size").alias("met"))
    heads = shared.join(met, "_fp").groupBy("token").agg(F.min(F.struct((-F.col("met")).alias("met"), "_fp")).alias("head")).select("token", F.col("head._fp").alias("head"))
    shared = materialize(shared.select("token", "_fp").join(heads, "token"), "headed", narrow=True)
    order = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    near = checked(shared.where("_fp <> head").select(*order("head", "_fp")), marked, sketch, like)
    root = connected_components(near, "a", "b").withColumnRenamed("node", "_fp")
    rooted = materialize(shared.join(root, "_fp", "left").withColumn("root", F.coalesce("root", "_fp")), "rooted", narrow=True)
    drop_files_of(shared)
    mixed = rooted.groupBy("token").agg(F.min("root").alias("r"), F.max("root").alias("s")).where("r < s").select("token")
    # The head has met all others there. Pairs are held to sizes and fingerprints where they
    # meet, so that none is written of the many that share a passage and little else.
    words, cells = min(COMPARED_WORDS, -(-parts * width // 64)), CELLS // 64
    bits = [F.element_at("_wide", k + 1).alias(f"w{k}") for k in range(words)]
    odd = [F.element_at("_parity", k + 1).alias(f"p{k}") for k in range(cells)]
    known = marked.select("_fp", F.col("_n").alias("n"), *bits, *odd).dropDuplicates(["_fp"])
    open_ = materialize(rooted.where("_fp <> head").join(mixed, "token", "left_semi").select("token", "_fp", "root").join(known, "_fp"), "open")
    drop_files_of(rooted)
    x, y = open_.alias("x"), open_.alias("y")
    p, q = like.numerator, like.denominator
    differ = lambda name, n: sum(F.bit_count(F.col(f"x.{name}{k}").bitwiseXOR(F.col(f"y.{name}{k}"))) for k in range(n))
    meet = (F.col("x.token") == F.col("y.token")) & (F.col("x._fp") < F.col("y._fp")) & (F.col("x.root") != F.col("y.root"))
    sizes = F.least("x.n", "y.n") * q >= F.greatest("x.n", "y.n") * p
    # As in ``may_link``: no pair alike enough has more odd cells than this.
    close = (differ("w", words) <= most_differing(64 * words, similarity)) & (differ("p", cells) * (q + p) <= (F.col("x.n") + F.col("y.n")) * (q - p))
    pairs = x.join(y, meet & sizes & close).select(F.col("x._fp").alias("a"), F.col("y._fp").alias("b"))
    return near.union(checked(pairs, marked, sketch, like))


def most_differing(bits: int, similarity: float) -> int:
    """Differing bits that a pair at the similarity exceeds by a chance of some thousandths of a percent."""
    differ = math.acos(2 * similarity / (1 + similarity)) / math.pi
    return math.ceil(bits * differ + 4 * math.sqrt(bits * differ * (1 - differ)))


def keep_one(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", radius: int = 2, words: int = 3) -> DataFrame:
    """``docs`` with one row of each component by ``radius``: that of the least id, then text hash."""
    marked = materialize(with_fingerprint(docs, [F.col(id_col).alias("_id"), row_key(id_col, text).alias("_key")], text, words), "simhash")
    return kept_rows(docs, marked, groups(marked, radius), id_col=id_col, text=text)


def keep_similar(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", words: int = 5, similarity: float = 0.8, recall: float = RECALL) -> DataFrame:
    """``docs`` with one row of each component of texts alike to ``similarity``: that of the least id, then text hash."""
    if not 0 < similarity <= 1 or not 0 < recall < 1:
        raise ValueError("similarity must be above 0 and at most 1, recall between both")
    total = docs.count()
    parts, width = wide_shape(total, similarity, recall)
    keys = [F.col(id_col).alias("_id"), row_key(id_col, text).alias("_key")]
    marked = materialize(with_shingles(docs, keys, text, words, -(-parts * width // 64)), "shingles")
    rows = materialize(marked.select("_id", "_key", "_fp"), "rows", narrow=True)
    found = connected_components(similar(marked, total, parts, width, similarity), "a", "b")
    drop_files_of(marked)
    roots = rows.select("_fp").distinct().join(found.withColumnRenamed("node", "_fp"), "_fp", "left").select("_fp", F.coalesce("root", "_fp").alias("_root"))
    return kept_rows(docs, rows, roots, id_col=id_col, text=text)
