"""SentencePiece encoding with N-best segmentation, and decoding (operator 3).

A text becomes a lattice: places between characters are nodes, pieces are edges with the model's scores, and
a character that no single-character piece covers is an edge to its bytes, scored below all pieces. The N
segmentations with the highest sums are found exactly, in two passes:

1. **Forward Viterbi** gives the best score from the start to every node.
2. **Backward A-star** grows partial segmentations from the end. A partial one is ranked by its own score plus
   the forward score of the node it has reached. As that is exactly what the best completion adds, complete
   segmentations leave the queue in order of score, and nothing is expanded in vain.

No piece of such a model crosses from a word to the next word's space mark, or from a letter to most signs,
so a text's lattice is a chain of small ones ("units"). Forward scores of all new units of a step are computed together, with backward
scores that tell how much each unit's second-best segmentation loses. Only units with the least losses can
differ from their best in the N best of the text: the A-star search runs in those. Units are remembered
up to a bound. (A model with pieces across words makes the whole text one unit.)

Decoding joins pieces and bytes. Space marks that stand in a text themselves are encoded as bytes, so every
text comes back unchanged.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeloom.llm.common import id_and_text, mix, steps

MARK = "▁"
# The unit for a space mark of the text itself; no other unit looks like it.
LITERAL = "\0" + MARK
LETTER = "[A-Za-zÀ-ÖØ-öø-ɏ]"
MEMORY = 300_000
# Units with more characters are solved one by one.
LONG = 64
ENCODED = "k long, rank int, score double, ids array<int>"
LISTED = "k long, score double, ids array<int>, others array<struct<score: double, ids: array<int>>>"
_HASH_BASE = np.uint64(0x9E3779B97F4A7C15)


def piece_bytes(proto: bytes) -> list[bytes]:
    """What each piece stands for in a text, by id."""
    import sentencepiece

    model, output = sentencepiece.SentencePieceProcessor(model_proto=proto), []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            output.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            output.append(b"")
        else:
            output.append(piece.replace(MARK, " ").encode())
    return output


class Model:
    """Pieces and scores of a model with byte fallback."""

    def __init__(self, proto: bytes):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        size = model.get_piece_size()
        self.byte_ids, self.ids, scores = {}, {}, {}
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.ids[piece] = i
                scores[piece] = float(model.get_score(i))
        if len(self.byte_ids) < 256:
            raise ValueError("the model has no byte fallback")
        self.scores = scores
        self.unknown = min(scores.values()) - 10.0
        self.longest = max(map(len, self.ids))
        self.units = self._unit_pattern()
        # Pieces by hash, behind a table that tells most other strings apart.
        names = list(self.ids)
        self.known = _substring_hashes(names)
        order = np.argsort(self.known)
        self.known = self.known[order]
        self.known_ids = np.array([self.ids[n] for n in names])[order]
        self.known_scores = np.array([scores[n] for n in names])[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.known >> np.uint64(44)).astype(np.int64)] = True

    def _unit_pattern(self) -> re.Pattern:
        """How to cut a text at places that no piece crosses.

        These are: before a space mark, around a character that no longer piece has, and between a
        letter and a sign that follows a letter in no piece.
        """
        if any(MARK in piece.lstrip(MARK) for piece in self.ids):
            return re.compile("(?s:.+)")
        longer = [piece for piece in self.ids if len(piece) > 1]
        inside = set("".join(longer))
        after_letter = {b for piece in longer for a, b in zip(piece, piece[1:]) if re.match(LETTER, a)}
        ascii_signs = [chr(c) for c in range(128) if not chr(c).isalnum()]
        alone = "".join(re.escape(c) for c in ascii_signs if c not in inside)
        signs = "".join(re.escape(c) for c in ascii_signs if c in inside and c not in after_letter)
        more = f"(?:[^{MARK}{alone}{signs}]+" + (f"|(?<!{LETTER})[{signs}])*" if signs else ")*")
        single = f"[{alone}]|" if alone else ""
        return re.compile(f"{single}{MARK}+{more}|[^{MARK}{alone}]{more}")

    def fallback(self, character: str) -> list[int]:
        return [self.byte_ids[b] for b in character.encode()]


def _substring_hashes(names: list[str]) -> np.ndarray:
    result = np.zeros(len(names), np.uint64)
    for i, name in enumerate(names):
        total = 0
        for c in name:
            total = (total * int(_HASH_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        result[i] = total
    return mix(result)


def edges_into(model: Model, text: str, end: int) -> Iterator[tuple[int, float, str]]:
    """``(start, score, piece)`` of the edges that end at a node."""
    for start in range(max(0, end - model.longest), end):
        score = model.scores.get(text[start:end])
        if score is not None:
            yield start, score, text[start:end]
        elif start == end - 1:
            yield start, model.unknown, text[start:end]


def forward_scores(model: Model, text: str) -> list[float]:
    best = [0.0] + [-np.inf] * len(text)
    for end in range(1, len(text) + 1):
        best[end] = max(best[start] + score for start, score, _ in edges_into(model, text, end))
    return best


def n_best(model: Model, text: str, n: int) -> list[tuple[float, list[int]]]:
    """The ``n`` best segmentations as ``(score, ids)``; equal scores come in one fixed order."""
    forward = forward_scores(model, text)
    # A partial segmentation: node reached, its score, its first piece and the partial one after it. Of
    # equal ranks the one nearest to the start comes first, so that ties are finished, not collected.
    queue = [(-forward[-1], len(text), 0, 0.0, None)]
    found, made = [], 0
    while queue and len(found) < n:
        _, node, _, score, chain = heapq.heappop(queue)
        if node == 0:
            ids = []
            while chain:
                piece, chain = chain
                ids += [model.ids[piece]] if piece in model.ids else model.fallback(piece)
            found.append((score, ids))
            continue
        for start, gain, piece in reversed(list(edges_into(model, text, node))):
            made += 1
            total = score + gain
            heapq.heappush(queue, (-(forward[start] + total), start, -made, total, (piece, chain)))
    return found


class Units:
    """Best segmentations of units, computed for many units at once and remembered by number."""

    def __init__(self, model: Model):
        self.model = model
        self.lists: dict[tuple[str, int], list[tuple[float, np.ndarray]]] = {}
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        # By number: score of the best segmentation, loss of the second best, place and size of the ids.
        self.score, self.loss = np.zeros(0), np.zeros(0)
        self.start, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _remember(self, units: list[str], score: np.ndarray, loss: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        self.numbers.update(zip(units, range(len(self.numbers), len(self.numbers) + len(units)), strict=True))
        self.start = np.r_[self.start, len(self.pool) + np.cumsum(size) - size]
        self.size, self.pool = np.r_[self.size, size], np.r_[self.pool, ids]
        self.score, self.loss = np.r_[self.score, score], np.r_[self.loss, loss]

    def numbered(self, units: list[str]) -> np.ndarray:
        """The number of each unit, after solving those that are new."""
        if len(self.numbers) > MEMORY:
            self._forget()
        known = self.numbers.get
        found = np.array([known(u, -1) for u in units], np.int64)
        missing = np.flatnonzero(found < 0).tolist()
        new = sorted({units[i] for i in missing}, key=len)
        for i in range(0, len(new), 1 << 15):
            part = new[i : i + (1 << 15)]
            literal = [u for u in part if u == LITERAL]
            if literal:
                # A space mark of the text itself: always its bytes.
                ids = np.array(self.model.fallback(MARK), np.int32)
                self._remember(literal, np.array([self.model.unknown]), np.array([np.inf]), np.array([len(ids)]), ids)
                part = [u for u in part if u != LITERAL]
            for unit in [u for u in part if len(u) > LONG]:
                self._solve_long(unit)
            part = [u for u in part if len(u) <= LONG]
            if part:
                self._solve(part)
        if missing:
            found[missing] = [known(units[i], -1) for i in missing]
        return found

    def _solve_long(self, unit: str) -> None:
        """One unit by itself: sweeping over places pays for many units only."""
        model, size = self.model, len(unit)
        edges = [list(edges_into(model, unit, end)) for end in range(size + 1)]
        forward, backward, via = [0.0] + [-np.inf] * size, [-np.inf] * size + [0.0], [None] * (size + 1)
        for end in range(1, size + 1):
            for start, score, piece in edges[end]:
                if forward[start] + score > forward[end]:
                    forward[end], via[end] = forward[start] + score, (start, piece)
        for end in range(size, 0, -1):
            for start, score, _ in edges[end]:
                backward[start] = max(backward[start], score + backward[end])
        path, node, ids = set(), size, []
        while node:
            start, piece = via[node]
            path.add((start, node))
            ids.append([model.ids[piece]] if piece in model.ids else model.fallback(piece))
            node = start
        others = (
            forward[start] + score + backward[end]
            for end in range(1, size + 1)
            for start, score, _ in edges[end]
            if (start, end) not in path
        )
        flat = np.array([i for piece in reversed(ids) for i in piece], np.int32)
        loss = forward[size] - max(others, default=-np.inf)
        self._remember([unit], np.array([forward[size]]), np.array([loss]), np.array([len(flat)]), flat)

    def _solve(self, units: list[str]) -> None:
        model = self.model
        points = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)
        sizes = np.array([len(u) for u in units])
        stops = np.cumsum(sizes)
        inside = np.arange(len(points)) - np.repeat(stops - sizes, sizes)
        left = np.repeat(stops, sizes) - np.arange(len(points))
        # Nodes of a unit of n characters are n + 1 numbers in a row.
        node = np.arange(len(points)) + np.repeat(np.arange(len(units)), sizes)
        parts, running = [], np.zeros(len(points), np.uint64)
        for length in range(1, min(model.longest, int(sizes[-1])) + 1):
            running = running * _HASH_BASE
            running[: len(points) - length + 1] += points[length - 1 :]
            name = mix(running)
            at = np.flatnonzero((left >= length) & model.maybe[(name >> np.uint64(44)).astype(np.int64)])
            spot = np.minimum(np.searchsorted(model.known, name[at]), len(model.known) - 1)
            hit = model.known[spot] == name[at]
            if length == 1:
                lacking = np.ones(len(points), bool)
                lacking[at[hit]] = False
                lost = np.flatnonzero(lacking)
                parts.append((node[lost], inside[lost], np.full(len(lost), 1), np.full(len(lost), model.unknown), -1 - lost))
            at, spot = at[hit], spot[hit]
            parts.append((node[at], inside[at], np.full(len(at), length), model.known_scores[spot], model.known_ids[spot]))
        start, place, length, score, name = (np.concatenate(column) for column in zip(*parts, strict=True))
        end, last = start + length, place + length

        def sweep(target: np.ndarray, source: np.ndarray, stage: np.ndarray, total: np.ndarray, via: np.ndarray | None) -> None:
            turn = stage * (model.longest + 1) + length
            order = np.argsort(turn)
            heads = np.flatnonzero(np.r_[True, np.diff(turn[order]) != 0])
            for a, b in zip(heads, np.r_[heads[1:], len(order)], strict=True):
                edge = order[a:b]
                reached = total[source[edge]] + score[edge]
                better = reached > total[target[edge]]
                edge = edge[better]
                total[target[edge]] = reached[better]
                if via is not None:
                    via[target[edge]] = edge

        count = len(points) + len(units)
        begins, finals = stops - sizes + np.arange(len(units)), stops + np.arange(len(units))
        forward, backward, via = np.full(count, -np.inf), np.full(count, -np.inf), np.full(count, -1)
        forward[begins], backward[finals] = 0.0, 0.0
        sweep(end, start, last, forward, via)
        sweep(start, end, place.max() - place, backward, None)
        best = forward[finals]
        # The second best leaves the best path somewhere: it is the best one through an edge outside it.
        on_path, at, turns = np.zeros(len(start), bool), finals.copy(), []
        unit = np.arange(len(units))
        while len(at):
            edge = via[at]
            on_path[edge] = True
            turns.append((unit, edge))
            at = start[edge]
            going = at != begins[unit]
            at, unit = at[going], unit[going]
        owner = np.repeat(np.arange(len(units)), sizes + 1)[start]
        loss = np.full(len(units), np.inf)
        off = np.flatnonzero(~on_path)
        np.minimum.at(loss, owner[off], best[owner[off]] - (forward[start[off]] + score[off] + backward[end[off]]))
        path_unit = np.concatenate([u for u, _ in turns])
        path_edge = np.concatenate([e for _, e in turns])
        order = np.lexsort((place[path_edge], path_unit))
        path_unit, ids = path_unit[order], name[path_edge[order]].astype(np.int64)
        size = np.bincount(path_unit, minlength=len(units))
        lost = np.flatnonzero(ids < 0)
        if len(lost):
            # A character without a piece becomes the pieces of its bytes.
            joined = "".join(units)
            as_bytes = [np.array(model.fallback(joined[-1 - i]), np.int64) for i in ids[lost].tolist()]
            counts = np.ones(len(ids), np.int64)
            counts[lost] = [len(x) for x in as_bytes]
            np.add.at(size, path_unit[lost], counts[lost] - 1)
            wide = np.repeat(ids, counts)
            wide[wide < 0] = np.concatenate(as_bytes)
            ids = wide
        self._remember(units, best, loss, size, ids.astype(np.int32))

    def alternatives(self, unit: str, n: int) -> list[tuple[float, np.ndarray]]:
        """``(loss, ids)`` of the second to ``n``-th best segmentation of a unit."""
        if (unit, n) not in self.lists:
            if len(self.lists) >= MEMORY // 4:
                self.lists.clear()
            found = n_best(self.model, unit, n)
            others = [(found[0][0] - score, np.array(ids, np.int32)) for score, ids in found[1:]]
            self.lists[unit, n] = others
        return self.lists[unit, n]


def _units_of(text: str, model: Model) -> list[str]:
    """A text as units; a space mark of the text itself is one of its own."""
    if not text:
        return []
    if MARK in text:
        head, *rest = re.split(f"({MARK})", text)
        found = _units_of(head, model) if head else [MARK]
        for part in rest:
            if part == MARK:
                found.append(LITERAL)
            elif part:
                found += _chain(part.replace(" ", MARK), model)
        return found
    return _chain(MARK + text.replace(" ", MARK), model)


def _chain(marked: str, model: Model) -> list[str]:
    return model.units.findall(marked)


def encode_texts(texts: list[str], units: Units, n: int) -> Iterator[tuple[int, int, float, np.ndarray]]:
    """``(text, rank, score, ids)`` of the ``n`` best segmentations of each text."""
    parts = [_units_of(text, units.model) for text in texts]
    flat = [u for part in parts for u in part]
    number = units.numbered(flat)
    size, loss = units.size[number], units.loss[number]
    # The best segmentation of all texts, one after another.
    ends = np.cumsum(size)
    ids = units.pool[np.repeat(units.start[number] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]
    ends, scores = np.r_[0, ends], units.score[number]
    begin = 0
    for i, part in enumerate(parts):
        end = begin + len(part)
        own, score = ids[ends[begin] : ends[end]], float(scores[begin:end].sum())
        yield i, 1, score, own
        if n > 1 and part:
            # Of the n best, none changes a unit outside those with the n - 1 least losses.
            losses = loss[begin:end]
            spots = np.argsort(losses, kind="stable")[: n - 1] if end - begin < 2 * n else np.argpartition(losses, n - 2)[: n - 1]
            combined: list[tuple[float, tuple]] = [(0.0, ())]
            for spot in sorted(s for s in spots.tolist() if losses[s] < np.inf):
                changed = [
                    (lost + more, (*changes, (spot, other)))
                    for lost, changes in combined
                    for more, other in units.alternatives(part[spot], n)
                ]
                combined = heapq.nsmallest(n, combined + changed, key=lambda c: c[0])
            for rank, (lost, changes) in enumerate(combined[1:], 2):
                pieces, at = [], ends[begin]
                for spot, other in changes:
                    pieces += [ids[at : ends[begin + spot]], other]
                    at = ends[begin + spot + 1]
                yield i, rank, score - lost, np.concatenate([*pieces, ids[at : ends[end]]])
        begin = end


def _encode(batches: Iterator[pa.RecordBatch], proto: bytes, n: int) -> Iterator[pa.RecordBatch]:
    units = Units(Model(proto))
    for step in steps(batches, limit=ENCODED_BYTES):
        rows = list(encode_texts(step.column("t").to_pylist(), units, n))
        text, rank, score, ids = zip(*rows, strict=True)
        offsets = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
        flat = pa.array(np.concatenate(ids).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [step.column("k").take(pa.array(text, pa.int32())), pa.array(rank, pa.int32()), pa.array(score, pa.float64()), pa.ListArray.from_arrays(pa.array(offsets), flat)],
            names=["k", "rank", "score", "ids"],
        )


def _id_lists(ids: list[np.ndarray]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int32)))


def _encode_lists(batches: Iterator[pa.RecordBatch], proto: bytes, n: int) -> Iterator[pa.RecordBatch]:
    units = Units(Model(proto))
    for step in steps(batches, limit=ENCODED_BYTES):
        rows = list(encode_texts(step.column("t").to_pylist(), units, n))
        best, more = [r for r in rows if r[1] == 1], [r for r in rows if r[1] > 1]
        fields = [pa.array([r[2] for r in more], pa.float64()), _id_lists([r[3] for r in more])]
        counts = np.bincount(np.array([r[0] for r in more], np.int64), minlength=step.num_rows)
        others = pa.ListArray.from_arrays(
            pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.StructArray.from_arrays(fields, names=["score", "ids"])
        )
        yield pa.RecordBatch.from_arrays(
            [step.column("k"), pa.array([r[2] for r in best], pa.float64()), _id_lists([r[3] for r in best]), others],
            names=["k", "score", "ids", "others"],
        )


def decode_ids(ids: list[int], output: list[bytes]) -> str:
    """The text of pieces; the first space mark was added by encoding and goes."""
    joined = b"".join([output[i] for i in ids])
    return (joined[1:] if joined[:1] == b" " else joined).decode("utf-8", "replace")


# Bytes of text that are encoded at a time.
ENCODED_BYTES = 1 << 19
# Pieces that are put together at a time; one longer list is a step of its own.
DECODED_PIECES = 1 << 19


class Output:
    """The bytes of all pieces one after another, and where each begins."""

    def __init__(self, pieces: list[bytes]):
        self.pieces = pieces
        self.size = np.array([len(p) for p in pieces], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(pieces), np.uint8)

    def texts(self, ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
        """The texts of lists of pieces that follow one another."""
        sizes = self.size[ids]
        ends = np.cumsum(sizes)
        data = self.pool[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[ids] - (ends - sizes), sizes)]
        marks = np.r_[0, ends][np.r_[0, np.cumsum(lengths)]]
        # The first space mark of each list goes.
        first = marks[:-1][marks[:-1] < marks[1:]]
        first = first[data[first] == 0x20]
        data = np.delete(data, first)
        marks = marks - np.searchsorted(first, marks)
        texts = pa.Array.from_buffers(pa.large_string(), len(lengths), [None, pa.py_buffer(marks), pa.py_buffer(data)])
        try:
            texts.validate(full=True)
        except pa.ArrowInvalid:
            parts = np.split(ids, np.cumsum(lengths)[:-1])
            return pa.array([decode_ids(part.tolist(), self.pieces) for part in parts], pa.string())
        return texts.cast(pa.string())


def _decode(batches: Iterator[pa.RecordBatch], proto: bytes, name: str) -> Iterator[pa.RecordBatch]:
    output = Output(piece_bytes(proto))
    for batch in batches:
        lengths = np.asarray(pc.fill_null(pc.list_value_length(batch.column("ids")), 0), np.int64)
        ends, begin = np.cumsum(lengths), 0
        while begin < batch.num_rows:
            before = ends[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + DECODED_PIECES, "right")))
            part = batch.slice(begin, end - begin)
            ids = part.column("ids")
            texts = output.texts(np.asarray(ids.flatten(), np.int64), lengths[begin:end])
            texts = pc.if_else(ids.is_valid(), texts, pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([*part.columns, texts], names=[*part.schema.names, name])
            begin = end


def read_model(path: str) -> bytes:
    """A model file, read on the driver and sent to the tasks with their code."""
    return Path(path).read_bytes()


def encode(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", n: int = 1) -> DataFrame:
    """``(k, rank, score, ids)``: the ``n`` best segmentations of every row's text, rank 1 the best.

    A text with fewer segmentations has fewer rows. NULL and empty texts have one row without ids and score 0.
    Equal scores are ordered alike in every run. NULL keys are kept; repeated rows repeat their
    results; an empty table gives an empty result. Other columns are not read.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    return id_and_text(docs, key, text).mapInArrow(partial(_encode, proto=read_model(model), n=n), ENCODED)


def encode_lists(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", n: int = 3) -> DataFrame:
    """``(k, score, ids, others)``: like ``encode`` with one row per text, the second to ``n``-th best in ``others``, by rank."""
    if n < 1:
        raise ValueError("n must be at least 1")
    return id_and_text(docs, key, text).mapInArrow(partial(_encode_lists, proto=read_model(model), n=n), LISTED)


def decode(encoded: DataFrame, model: str, name: str = "decoded") -> DataFrame:
    """The rows with the text of their ``ids`` in a column of a new name; NULL ids give NULL."""
    if name in encoded.columns:
        raise ValueError(f"column {name} exists already")
    schema = encoded.limit(0).withColumn(name, F.lit(None).cast("string")).schema
    return encoded.mapInArrow(partial(_decode, proto=read_model(model), name=name), schema)
