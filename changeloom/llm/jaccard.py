"""N-gram Jaccard join by universe-partition pigeonhole (operator 8).

Every document is the set of its word shingles. Two sets link when their Jaccard similarity reaches a
threshold. Then they differ in few shingles: at most ``t * (1 - s) / s``, with ``t`` the size of the smaller.

* **Classes.** Equal sets are one class; only classes are joined.
* **Segments by size band.** A band of sizes ``[low, high)`` stands for the smaller set of a pair. The
  universe of shingles is hashed into segments, a few more than differences are possible in the band, so
  that linked sets agree in some segment. A set takes part in each band in which it may be smaller or larger.
* **Cost-based allocation.** An empty segment is agreed on by all sets that lack it, so it is
  skipped. That loses nothing while a set has more filled segments than differences allowed. Sets with
  fewer ("thin" sets) also index the one-deletion neighbourhood of their segments, which finds segments with one
  difference and so counts twice; if even that is not enough, they index their empty segments too. A pair
  can only be missed by the plain rule if both sets are thin, and then both follow the other one.
  Filled segments beyond those needed are a set's budget: it may skip as many signatures. It skips those
  that are hot (held by more than ``HOT`` classes, such as parts of a passage in many documents), the
  most frequent first. The order by frequency is the same for all sets, so of the signatures that two
  linked sets agree on both skip a beginning only, each shorter than the whole: one is left to both.
* **Candidates.** Signatures are dealt to groups. Up to ``HOT`` classes with a signature are paired. Of its hot
  ones a class takes the most frequent, and is paired with the least class there: a star, never all pairs.
* **Exact verification.** First one edge per class is verified, then components are formed, then what could
  still join two components: the other candidates, and classes of different components that share a
  kept hot signature. Those are partitioned anew, a shingle a segment, rarest first, which tells
  documents with one passage in common apart from alike ones. In rounds, each class there tries the most
  alike of the centres of its shingles, other ones each round, and components are formed again; only
  then the pairs that are left are listed, all of them. Both pass a bitmap filter: the parity
  bits of two sets differ in at most as many places as the sets themselves. Pairs inside one component are
  never expanded, so a large group of copies, or of near copies that mostly link, costs some stars.

Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeloom.llm.common import (
    Words,
    gram_hashes,
    id_and_text,
    mix,
    partitions_for,
    steps,
    stored,
)
from changeloom.llm.components import components

LARGEST = 1 << 31
# A signature of more classes than this is hot.
HOT = 8
# Rounds of trials at most, trials of a class in each, and the share of them that must link for another round.
ROUNDS, TRIALS, PAYS = 4, 3, 0.5


class Rule(NamedTuple):
    """Sets link when ``100 * intersection >= percent * union``."""

    shingle: int = 5
    percent: int = 80

    def differences(self, smaller):
        return smaller * (100 - self.percent) // self.percent

    def bands(self) -> list[tuple[int, int, int]]:
        """``(low, high, segments)`` of each band."""
        found, low = [], 1
        while low < LARGEST:
            high = max(low + 1, low * 3 // 2)
            most = self.differences(high - 1)
            # Segments above what the pigeonhole asks for keep thin sets rare and pay for hot ones.
            found.append((low, high, 1 if not most else most + 3 + 4 * most // 5))
            low = high
        return found


def _by_owner(values: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The order by owner, then value; the number of owners in a step is small."""
    order = np.argsort(values)
    return order[np.argsort(owner[order].astype(np.uint32 if len(owner) and owner[-1] > 65535 else np.uint16), kind="stable")]


def shingle_sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each text; the owner of each; the size of each set."""
    words = Words(column, lower=True)
    hashes, owner = words.hashes(), words.owners()
    grams = gram_hashes(hashes, n)
    whole = owner[: len(grams)] == owner[n - 1 :]
    grams, gram_owner = grams[whole], owner[: len(grams)][whole]
    short = np.flatnonzero((words.counts > 0) & (words.counts < n))
    if len(short):
        # The whole sequence is the only shingle; its length keeps it apart from longer ones.
        single = [gram_hashes(hashes[words.first[i] : words.first[i + 1]], int(words.counts[i]))[0] for i in short]
        grams, gram_owner = np.r_[grams, np.array(single, np.uint64)], np.r_[gram_owner, short]
        order = np.argsort(gram_owner, kind="stable")
        grams, gram_owner = grams[order], gram_owner[order]
    order = _by_owner(grams, gram_owner)
    grams, gram_owner = grams[order], gram_owner[order]
    if len(grams):
        new = np.r_[True, (grams[1:] != grams[:-1]) | (gram_owner[1:] != gram_owner[:-1])]
        grams, gram_owner = grams[new], gram_owner[new]
    return grams, gram_owner, np.bincount(gram_owner, minlength=len(column))


def _classes(grams: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set."""
    total = np.zeros(len(sizes), np.uint64)
    np.add.at(total, owner, mix(grams + np.uint64(0x51ED270B)))
    return mix(total + sizes.astype(np.uint64)).view(np.int64)


def _parity_bits(grams: np.ndarray, size: int) -> bytes:
    """Which of the cells, about two per shingle, were hit an odd number of times."""
    width = 64
    while width < 2 * size:
        width *= 2
    odd = np.bincount((grams >> np.uint64(8)).astype(np.int64) & (width - 1), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _folded_bits(grams: np.ndarray) -> np.ndarray:
    """The same for 512 cells, as eight numbers, for sets of any size."""
    odd = np.bincount((grams >> np.uint64(8)).astype(np.int64) & 511, minlength=512) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _differ() -> Column:
    """In how many places the folded bits of two classes differ."""
    return F.aggregate(
        F.zip_with("fa", "fb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda total, x: total + x
    )


def _may_link(rule: Rule) -> Column:
    """Whether sizes and folded bits of two classes leave room for a link."""
    small, large = F.least("na", "nb"), F.greatest("na", "nb")
    allowed = F.floor(small * (100 - rule.percent) / rule.percent)
    return (100 * small >= rule.percent * large) & (_differ() <= allowed)


def _sketches(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for step in steps(batches):
        grams, owner, sizes = shingle_sets(step.column("t"), rule.shingle)
        ends = np.cumsum(sizes)
        bits = [_parity_bits(grams[e - n : e], int(n)) for e, n in zip(ends, sizes, strict=True)]
        folded = np.concatenate([_folded_bits(grams[e - n : e]) for e, n in zip(ends, sizes, strict=True)])
        eights = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * 8), pa.array(folded))
        yield pa.RecordBatch.from_arrays(
            [step.column("k"), pa.array(sizes, pa.int64()), pa.array(_classes(grams, owner, sizes)), pa.array(bits, pa.binary()), eights],
            names=["k", "n", "c", "bits", "f"],
        )


def _signatures(grams: np.ndarray, owner: np.ndarray, sizes: np.ndarray, rule: Rule) -> Iterator[tuple]:
    """``(signature, owner, tag, budget)`` arrays, band by band."""
    for tag, (low, high, segments) in enumerate(rule.bands()):
        smallest_partner = -(-sizes * rule.percent // 100)
        member = (sizes >= low) & (smallest_partner < high)
        if not member.any():
            if low > sizes.max(initial=0):
                return
            continue
        chosen = np.flatnonzero(member)
        row = np.full(len(sizes), -1)
        row[chosen] = np.arange(len(chosen))
        mine = row[owner] >= 0
        values, row = grams[mine], row[owner[mine]]
        place = (mix(values ^ np.uint64(0xA5A5 + tag)) >> np.uint64(32)) * np.uint64(segments) >> np.uint64(32)
        place = row * segments + place.astype(np.int64)
        content = np.zeros(len(chosen) * segments, np.uint64)
        weight = mix(values + np.uint64(0x2545F491 + tag))
        np.add.at(content, place, weight)
        filled = np.bincount(place, minlength=len(content))
        names = np.tile(mix(np.arange(segments, dtype=np.uint64) + np.uint64(tag << 40)), len(chosen))
        table = filled.reshape(len(chosen), segments)
        allowed = rule.differences(np.minimum(sizes[chosen], high - 1))
        budget = (table > 0).sum(1) - allowed - 1

        at = np.flatnonzero(filled)
        parts = [(mix(content[at] + names[at]), at // segments)]
        thin = budget < 0
        if thin.any():
            spots = place[several := thin[row] & (filled[place] > 1)]
            parts.append((mix(content[spots] - weight[several] + names[spots]), spots // segments))
            very = thin & ((table > 0).sum(1) + (table > 1).sum(1) <= allowed)
            empty = np.flatnonzero((table == 0) & very[:, None])
            parts.append((mix(names[empty]), empty // segments))
        of = np.concatenate([p[1] for p in parts])
        yield np.concatenate([p[0] for p in parts]), chosen[of], np.full(len(of), tag, np.int16), budget[of].astype(np.int32)


_RECORDS = {"c": np.int64, "tag": np.int16, "budget": np.int32, "count": np.int32}
_INDEX = "g int, signature binary, " + ", ".join(f"{name} binary" for name in _RECORDS)


def _index(batches: Iterator[pa.RecordBatch], rule: Rule, groups: int) -> Iterator[pa.RecordBatch]:
    for step in steps(batches):
        grams, owner, sizes = shingle_sets(step.column("t"), rule.shingle)
        classes = _classes(grams, owner, sizes)
        # Equal sets of a step are indexed once.
        first = np.zeros(len(sizes), bool)
        first[np.unique(classes, return_index=True)[1]] = True
        kept = first[owner]
        parts = list(_signatures(grams[kept], owner[kept], np.where(first, sizes, 0), rule))
        if not parts:
            continue
        signature, of, tag, budget = (np.concatenate(column) for column in zip(*parts, strict=True))
        group = ((signature >> np.uint64(40)) % np.uint64(groups)).astype(np.int64)
        # A record is a set in a band; its signatures of a group follow each other.
        order = np.argsort((group * len(sizes) + of) * 64 + tag)
        signature, of, tag, budget, group = (x[order] for x in (signature, of, tag, budget, group))
        heads = np.flatnonzero(np.r_[True, (np.diff(group) != 0) | (np.diff(of) != 0) | (np.diff(tag) != 0)])
        values = {"c": classes[of[heads]], "tag": tag[heads], "budget": budget[heads], "count": np.diff(np.r_[heads, len(of)])}
        # Five bytes of a signature tell candidates well enough; all of them are verified.
        low = signature.view(np.uint8).reshape(-1, 8)[:, :5]
        begins = np.flatnonzero(np.r_[True, np.diff(group[heads]) != 0])
        columns: dict[str, list] = {name: [] for name in ["g", "signature", *_RECORDS]}
        for a, b in zip(begins, np.r_[begins[1:], len(heads)], strict=True):
            columns["g"].append(int(group[heads[a]]))
            columns["signature"].append(low[heads[a] : heads[b] if b < len(heads) else len(of)].tobytes())
            for name, kind in _RECORDS.items():
                columns[name].append(values[name][a:b].astype(kind).tobytes())
        kinds = [pa.int32()] + [pa.binary()] * (len(columns) - 1)
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns.values(), kinds, strict=True)], names=list(columns))


def _rows(**columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    size = len(next(iter(columns.values())))
    for i in range(0, size, 1 << 16):
        arrays = [pa.array(c[i : i + (1 << 16)].astype(np.int64)) for c in columns.values()]
        yield pa.RecordBatch.from_arrays(arrays, names=list(columns))


_FOUND = "hot long, a long, b long, times long, tag long, budget long"


def _pairs_of_runs(member: np.ndarray, heads: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs within runs of at most ``HOT`` sorted members."""
    a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size in range(2, HOT + 1):
        runs = member[heads[sizes == size][:, None] + np.arange(size)]
        for i in range(size):
            for j in range(i + 1, size):
                a.append(runs[:, i])
                b.append(runs[:, j])
    return np.concatenate(a), np.concatenate(b)


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs ``(a, b, times)`` of the signatures of a group; of hot ones ``(a = class, b = signature)``
    with ``times``, how many classes it has, ``tag`` and ``budget``."""
    held: dict[str, list[bytes]] = {name: [] for name in ["signature", *_RECORDS]}
    for batch in batches:
        for name, into in held.items():
            into += batch.column(name).to_pylist()
    wide = np.frombuffer(b"".join(held.pop("signature")), np.uint8).reshape(-1, 5)
    if not len(wide):
        return
    record = {name: np.frombuffer(b"".join(held[name]), kind) for name, kind in _RECORDS.items()}
    del held
    of = np.repeat(np.arange(len(record["c"]), dtype=np.int32), record["count"])
    signature = np.zeros((len(wide), 8), np.uint8)
    signature[:, :5] = wide
    signature = signature.view(np.uint64)[:, 0]
    # Only signatures that occur again matter.
    order = np.argsort(signature)
    again = signature[order][1:] == signature[order][:-1]
    order = order[np.r_[again, False] | np.r_[False, again]]
    order = order[np.lexsort((record["c"][of[order]], signature[order]))]
    signature, of = signature[order], of[order]
    member = record["c"][of]
    new = np.r_[True, (signature[1:] != signature[:-1]) | (member[1:] != member[:-1])][: len(member)]
    signature, of, member = signature[new], of[new], member[new]
    if not len(member):
        return
    heads = np.flatnonzero(np.r_[True, signature[1:] != signature[:-1]])
    held_by = np.diff(np.r_[heads, len(member)])
    centre, width = np.repeat(member[heads], held_by), np.repeat(held_by, held_by)
    a, b = _pairs_of_runs(member, heads, held_by)
    _, at, times = np.unique(mix(a.view(np.uint64)) + b.view(np.uint64), return_index=True, return_counts=True)
    none = np.zeros(len(at), np.int64)
    yield from _rows(hot=none, a=a[at], b=b[at], times=times, tag=none, budget=none)
    hot = np.flatnonzero(width > HOT)
    # The name of a signature in all groups; groups themselves are told apart by one of its classes.
    name = mix(signature[hot] + mix(centre[hot].view(np.uint64))).view(np.int64)
    one = np.ones(len(hot), np.int64)
    yield from _rows(hot=one, a=member[hot], b=name, times=width[hot], tag=record["tag"][of[hot]], budget=record["budget"][of[hot]])


def _kept_hot(found: DataFrame) -> DataFrame:
    """``(signature, c)`` of the hot signatures that a set cannot afford to skip."""
    rank = F.row_number().over(Window.partitionBy("a", "tag").orderBy(F.desc("times"), "b"))
    hot = found.where("hot = 1").select("a", "b", "budget", rank.alias("rank"))
    return hot.where("rank > budget").select(F.col("b").alias("signature"), F.col("a").alias("c"))


def _hot_stars(kept: DataFrame) -> DataFrame:
    """One pair per class: with the least class of its most frequent kept hot signature."""
    centres = kept.groupBy("signature").agg(F.min("c").alias("a"), F.count("*").alias("size"))
    stars = kept.join(centres, "signature").where("a <> c")
    one = stars.groupBy(F.col("c").alias("b")).agg(F.max_by("a", F.struct("size", "signature")).alias("a"))
    return one.select("a", "b", F.lit(1).cast("long").alias("times"))


def _shingles(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for step in steps(batches, limit=1 << 20):
        grams, owner, _ = shingle_sets(step.column("t"), rule.shingle)
        yield pa.RecordBatch.from_arrays([step.column("c").take(pa.array(owner)), pa.array(grams.view(np.int64))], names=["c", "shingle"])


def _of_several(rows: DataFrame, labels: DataFrame, by: str) -> DataFrame:
    """The rows whose ``by`` is shared by classes of different components, with the ``label`` of the component."""
    named = rows.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))
    ends = named.groupBy(by).agg(F.min("label").alias("low"), F.max("label").alias("high"))
    return named.join(ends.where("low <> high").select(by), by)


def _prefixes(kept: DataFrame, labels: DataFrame, classes: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The rarest shingles of the classes that share a kept hot signature with another component.

    What makes such a signature hot, a passage of many documents, does not make them alike. So the classes
    are partitioned once more, as finely as can be, a segment per shingle: in the order from the rarest shingle on,
    two linked sets share one among the first of either, as many as can differ and one more, which are fewer for
    the smaller set of a pair.
    """
    mixed = _of_several(kept, labels, "signature").select("c").distinct()
    members = stored(mixed.join(classes.select("c", "n", "f"), "c"), "mixed", free=True)
    rows = texts.join(members.select("c"), "c", "left_semi").mapInArrow(partial(_shingles, rule=rule), "c long, shingle long")
    rows = stored(rows, "shingles", free=True)
    common = rows.groupBy("shingle").agg(F.count("*").alias("held"))
    ranked = rows.join(common, "shingle").withColumn(
        "rank", F.row_number().over(Window.partitionBy("c").orderBy("held", "shingle"))
    )
    # A linked partner holds ``percent`` of the set at least; one that is no smaller holds more.
    many = F.col("n") - F.ceil(F.col("n") * rule.percent / 100) + 1
    few = F.col("n") - F.ceil(F.col("n") * (2 * rule.percent) / (100 + rule.percent)) + 1
    prefix = ranked.join(members, "c").where(F.col("rank") <= many)
    return stored(prefix.select("shingle", "c", "n", "f", "rank", (F.col("rank") <= few).alias("few")), "prefixes", free=True)


def _trials(prefixes: DataFrame, labels: DataFrame, tried: DataFrame, number: int, rule: Rule) -> DataFrame:
    """A few pairs ``(a, b)`` per class that may join two components: with the most alike centres of its shingles.

    The centre of a shingle is any class with it, another one in each round.
    """
    rows = _of_several(prefixes, labels, "shingle")
    lot = F.xxhash64("c", "shingle", F.lit(number))
    centres = rows.groupBy("shingle").agg(F.min_by(F.struct("c", "label", "n", "f"), F.struct(lot, "c")).alias("centre"))
    star = rows.join(centres, "shingle").where("label <> centre.label")
    star = star.select(
        "c", F.least("c", "centre.c").alias("a"), F.greatest("c", "centre.c").alias("b"),
        F.col("n").alias("na"), F.col("centre.n").alias("nb"), F.col("f").alias("fa"), F.col("centre.f").alias("fb"),
    )
    star = star.where(_may_link(rule)).select("c", "a", "b", _differ().alias("differ")).distinct()
    star = star.join(tried, ["a", "b"], "left_anti")
    rank = F.row_number().over(Window.partitionBy("c").orderBy("differ", "a", "b"))
    return star.withColumn("rank", rank).where(F.col("rank") <= TRIALS).select("a", "b").distinct()


def _strangers(prefixes: DataFrame, labels: DataFrame, rule: Rule) -> DataFrame:
    """All pairs of classes of different components that share a shingle of their prefixes and may link."""
    split = _of_several(prefixes, labels, "shingle")
    names = ("c", "label", "n", "f", "rank")
    small, large = (rows.select("shingle", *[F.col(x).alias(f"{x}{side}") for x in names]) for rows, side in ((split.where("few"), "a"), (split, "b")))
    # The first shingle that a pair shares leaves both room for all that it must share.
    needed = F.ceil((F.col("na") + F.col("nb")) * rule.percent / (100 + rule.percent))
    room = 1 + F.least(F.col("na") - F.col("ranka"), F.col("nb") - F.col("rankb")) >= needed
    in_order = (F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("ca") < F.col("cb")))
    met = small.join(large, "shingle").where(in_order & (F.col("labela") != F.col("labelb")) & room & _may_link(rule))
    return met.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))


def _alike(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Of pairs with sizes and parity bits, those that the sizes and bits do not rule out."""
    for batch in batches:
        na, nb = (np.asarray(batch.column(c), np.int64) for c in ("na", "nb"))
        small, large = np.minimum(na, nb), np.maximum(na, nb)
        fits = np.flatnonzero(100 * small >= rule.percent * large)
        left, right = batch.column("bitsa"), batch.column("bitsb")
        keep = []
        for i in fits:
            x, y = (np.frombuffer(side[int(i)].as_py(), np.uint8) for side in (left, right))
            while len(x) != len(y):
                # Half as many cells: a cell's parity is that of the two it stands for.
                if len(x) > len(y):
                    x = x[: len(x) // 2] ^ x[len(x) // 2 :]
                else:
                    y = y[: len(y) // 2] ^ y[len(y) // 2 :]
            if int(np.bitwise_count(x ^ y).sum()) <= rule.differences(int(small[i])):
                keep.append(i)
        yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))


def _verified(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    for step in steps(batches, "ta", 1 << 20):
        sets = [shingle_sets(step.column(c), rule.shingle) for c in ("ta", "tb")]
        grams, owner = (np.concatenate([sets[0][i], sets[1][i]]) for i in (0, 1))
        order = np.lexsort((grams, owner))
        grams, owner = grams[order], owner[order]
        equal = (grams[1:] == grams[:-1]) & (owner[1:] == owner[:-1])
        both = np.bincount(owner[1:][equal], minlength=step.num_rows)
        union = sets[0][2] + sets[1][2] - both
        linked = (union > 0) & (100 * both >= rule.percent * union)
        yield step.select(["a", "b"]).filter(pa.array(linked))


def _of_class(batches: Iterator[pa.RecordBatch], rule: Rule) -> Iterator[pa.RecordBatch]:
    """Texts without those of other rows that share the key of a class."""
    for step in steps(batches):
        classes = _classes(*shingle_sets(step.column("t"), rule.shingle))
        yield step.select(["c", "t"]).filter(pa.array(classes == np.asarray(step.column("c"), np.int64)))


def _links(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """The pairs of classes that link, after comparing their whole sets."""
    side = lambda name: texts.select(F.col("c").alias(name), F.col("t").alias(f"t{name}"))
    joined = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "ta", "tb")
    return joined.mapInArrow(partial(_verified, rule=rule), "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", rule: Rule = Rule()) -> DataFrame:
    """Per row: the key as ``k``, ``n_shingles``, ``class_id`` and ``component_id``.

    ``class_id`` is the least key with the same set, ``component_id`` the least key that links reach. Texts are
    lower-cased (A-Z). A text with fewer words than a shingle is one shingle; NULL, empty and blank texts are
    empty sets, linked with nothing, so both ids are their own key. Rows with a NULL key link with nothing
    and have NULL ids. Rows that share a key are separate rows with their own sets. An empty table
    gives an empty result. Other columns are not read.
    """
    groups = partitions_for(docs)
    source = id_and_text(docs, key, text)
    sketches = stored(source.mapInArrow(partial(_sketches, rule=rule), "k long, n long, c long, bits binary, f array<long>"), "sketches", free=True)
    filled = sketches.where("n > 0 AND k IS NOT NULL")
    classes = stored(filled.groupBy("c").agg(F.min("k").alias("k"), F.max("n").alias("n"), F.max("bits").alias("bits"), F.max("f").alias("f")), "classes", free=True)

    index = source.where("k IS NOT NULL").mapInArrow(partial(_index, rule=rule, groups=groups), _INDEX)
    found = stored(index.repartitionById(groups, "g").mapInArrow(_stars, _FOUND), "found", free=True)
    kept = stored(_kept_hot(found), "hot", free=True)
    plain = found.where("hot = 0").select("a", "b", "times").union(_hot_stars(kept))
    stars = stored(plain.groupBy("a", "b").agg(F.sum("times").alias("times")), "candidates", free=True)
    nodes = stars.select(F.col("a").alias("c")).union(stars.select(F.col("b").alias("c"))).union(kept.select("c")).distinct()
    places = nodes.join(classes, "c").select("c", "k")
    texts = source.join(places.hint("shuffle_hash"), "k").select("c", "t")
    texts = stored(texts.mapInArrow(partial(_of_class, rule=rule), "c long, t string"), "texts", free=True)

    first = stars.groupBy("b").agg(F.max_by("a", F.struct("times", "a")).alias("a"))
    links = stored(_links(first, texts, rule), "links", free=True)
    labels = components(links)

    prefixes = _prefixes(kept, labels, classes, texts, rule)
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    for number in range(ROUNDS):
        trials = stored(_trials(prefixes, labels, tried, number, rule), "trials", free=True)
        more = stored(_links(trials, texts, rule), "links", free=True)
        new, of = more.count(), trials.count()
        if new:
            links, tried = links.union(more), tried.union(trials)
            labels = components(links)
        if new <= of * PAYS:
            break

    def label_of(pairs: DataFrame, column: str) -> DataFrame:
        own = labels.select(F.col("c").alias(column), F.col("label").alias(f"label_{column}"))
        joined = pairs.join(own, column, "left")
        return joined.withColumn(f"label_{column}", F.coalesce(f"label_{column}", column))

    split = label_of(label_of(stars.select("a", "b"), "a"), "b").where("label_a <> label_b").select("a", "b")
    rest = split.union(_strangers(prefixes, labels, rule)).distinct()
    for columns in (("n", "f"), ("bits",)):
        for side in ("a", "b"):
            named = [F.col(c).alias(f"{c}{side}") for c in columns]
            rest = rest.join(classes.select(F.col("c").alias(side), *named), side)
        rest = rest.where(_may_link(rule)).select("a", "b", "na", "nb") if columns[0] == "n" else rest
    rest = stored(rest.mapInArrow(partial(_alike, rule=rule), "a long, b long"), "pairs", free=True)
    more = stored(_links(rest, texts, rule), "links", free=True)
    if not more.isEmpty():
        labels = components(links.union(more))

    of_class = classes.select("c", F.col("k").alias("class_id")).join(labels, "c", "left")
    of_class = of_class.withColumn("label", F.coalesce("label", "c"))
    least = of_class.groupBy("label").agg(F.min("class_id").alias("component_id"))
    of_class = of_class.join(least, "label").select("c", "class_id", "component_id")
    linked = sketches.select("k", "n", F.when(F.expr("n > 0 AND k IS NOT NULL"), F.col("c")).alias("c"))
    joined = linked.join(of_class, "c", "left")
    return joined.select(
        "k",
        F.col("n").alias("n_shingles"),
        F.coalesce("class_id", "k").alias("class_id"),
        F.coalesce("component_id", "k").alias("component_id"),
    )
