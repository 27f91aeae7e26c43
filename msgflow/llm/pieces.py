"""SentencePiece encoding and decoding by a max-plus scan.

The encoding of a text is the segmentation into pieces with the largest sum of the model's
piece scores (whole numbers); characters without a piece become byte pieces at a penalty. It is
the best segmentation, not the order of merges in which a merge-trained model would join pieces.

No piece joins a space mark to what stands before it, so words are segmented one by one and
each distinct word once. Giant texts are cut into chunks at any character. The state at a
boundary is the number of characters that a piece begun before it reaches over; a chunk yields
the matrix of best sums from every state at its start to every state at its end. Matrices are
combined associatively (largest sum over the state between) in a tree of `FAN` neighbours, the
states at all boundaries are fixed on the way back down, and then every chunk is traced on its
own. No task holds a giant text or its ids.

Results for odd input: null and empty text has no ids; repeated rows are encoded alike; on
equal sums the longer last piece wins, at a boundary the smaller state; a text that holds the
space mark itself decodes with spaces there; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from msgflow.llm.common import bounds, own_columns, release, whole_groups
from msgflow.llm.word_tokens import WordCache
from msgflow.session import stage

CHUNK_CHARS = 16_384  # longer texts are cut
FAN = 64  # neighbouring matrices combined at once
MARK = "▁"  # stands for a space
_STEPPED, _TOGETHER = 48, 8_192  # longer words are segmented alone; so many shorter ones at once
_BLOCK = 64  # chunks whose words are looked up at once
NONE = -(1 << 62)  # no such path
_CUT = re.compile(f"[^{MARK}](?={MARK})")
_WORD = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


_BASE, _ONE = np.uint64(0x9E3779B97F4A7C15), np.uint64(1)


def _hash(piece: str) -> int:
    value = 0
    for c in piece:
        value = (value * int(_BASE) + ord(c) + 1) % (1 << 64)
    return value


class PieceModel:
    """Pieces and scores of a model file."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: dict[str, tuple[int, int]] = {}
        self.text: list[bytes] = []  # what a piece decodes to
        self.scores = np.zeros(model.get_piece_size(), np.int64)
        self.byte_ids: dict[int, int] = {}
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.text.append(bytes([int(piece[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.text.append(b"")
            else:
                self.scores[i] = round(model.get_score(i))
                self.pieces[piece] = (int(self.scores[i]), i)
                self.text.append(piece.replace(MARK, " ").encode())
        if any(MARK in piece.lstrip(MARK) for piece in self.pieces):
            raise ValueError("a piece of this model joins a space to what stands before it")
        self.reach = max(map(len, self.pieces))
        self.penalty = int(self.scores.min()) - 10  # of a character without a piece, on its first byte
        for byte, i in self.byte_ids.items():
            self.scores[i] = 0 if 0x80 <= byte < 0xC0 else self.penalty

        self.ascii_ids = np.array([self.byte_ids.get(code, -1) for code in range(128)] + [-1], np.int64)
        # Hashes of all beginnings of pieces, sorted: id of the piece, or -1 where only longer pieces begin so.
        begun = {piece[:n] for piece in self.pieces for n in range(1, len(piece) + 1)}
        hashes = np.array([_hash(p) for p in begun], np.uint64)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two beginnings of pieces share a hash")
        self.begun = np.array([self.pieces.get(p, (0, -1))[1] for p in begun], np.int64)[order]

    @staticmethod
    @lru_cache(maxsize=2)
    def shared(path: str) -> PieceModel:
        return PieceModel(path)

    def forward(self, text: str, limit: int) -> tuple[list[int], list[int]]:
        """Best sums and lengths of the last piece up to every position; pieces begin before `limit` only."""
        best, last = [NONE] * (len(text) + 1), [0] * (len(text) + 1)
        best[0] = 0
        for i in range(min(limit, len(text))):
            if best[i] == NONE:
                continue
            for size in range(1, min(self.reach, len(text) - i) + 1):
                found = self.pieces.get(text[i : i + size])
                if found is None:
                    if size > 1:
                        continue
                    found = (self.penalty, -1)
                total = best[i] + found[0]
                # Positions are reached by longer pieces first: a tie keeps the longer one.
                if total > best[i + size]:
                    best[i + size], last[i + size] = total, size
        return best, last

    def backtrace(self, text: str, last: list[int]) -> list[int]:
        ids: list[list[int]] = []
        end = len(text)
        while end:
            piece = text[end - last[end] : end]
            found = self.pieces.get(piece)
            ids.append([found[1]] if found else [self.byte_ids[b] for b in piece.encode()])
            end -= last[end]
        return [i for part in reversed(ids) for i in part]

    def segment(self, text: str, limit: int | None = None) -> list[int]:
        """Ids of the best segmentation of a whole text."""
        return self.backtrace(text, self.forward(text, len(text) if limit is None else limit)[1])

    def segment_many(self, texts: list[str]) -> list[list[int]]:
        """`segment` of many short texts, which take every step together."""
        result: list[list[int]] = [[]] * len(texts)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        for i in np.flatnonzero(lengths > _STEPPED).tolist():
            result[i] = self.segment(texts[i])
        places = np.flatnonzero((lengths > 0) & (lengths <= _STEPPED))
        places = places[np.argsort(-lengths[places], kind="stable")]
        for begin in range(0, len(places), _TOGETHER):
            some = places[begin : begin + _TOGETHER]
            for i, ids in zip(some.tolist(), self._segment_together([texts[i] for i in some.tolist()], lengths[some])):
                result[i] = self.segment(texts[i]) if ids is None else ids
        return result

    def _segment_together(self, texts: list[str], lengths: np.ndarray) -> list[list[int] | None]:
        """Ids of texts in order of falling length; None where a character beyond ASCII has no piece."""
        count, n = len(texts), int(lengths[0])
        filled = np.arange(n) < lengths[:, None]
        points = np.zeros((count, n), np.uint64)
        points[filled] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        points = np.ascontiguousarray(points.T)
        longer = np.searchsorted(-lengths, -np.arange(n), "left")  # so many texts are longer than i
        best = np.full((n + 1, count), NONE, np.int64)
        last = np.zeros((n + 1, count), np.int32)
        piece = np.full((n + 1, count), -1, np.int32)
        best[0] = 0
        top = len(self.hashes) - 1
        for i in range(n):
            active, hashed = np.arange(longer[i]), np.zeros(longer[i], np.uint64)
            for size in range(1, min(self.reach, n - i) + 1):
                if size > 1:  # a text that ends here has no longer piece
                    inside = np.searchsorted(active, longer[i + size - 1])
                    active, hashed = active[:inside], hashed[:inside]
                hashed = hashed * _BASE + points[i + size - 1, active] + _ONE
                spot = np.minimum(np.searchsorted(self.hashes, hashed), top)
                known = self.hashes[spot] == hashed
                ids = np.where(known, self.begun[spot], -1)
                if size == 1:
                    whole, found = active, ids
                    score = np.where(ids >= 0, self.scores[ids], self.penalty)
                else:
                    is_piece = ids >= 0
                    whole, found = active[is_piece], ids[is_piece]
                    score = self.scores[found]
                total = best[i, whole] + score
                better = total > best[i + size, whole]
                at = whole[better]
                best[i + size, at], last[i + size, at], piece[i + size, at] = total[better], size, found[better]
                active, hashed = active[known], hashed[known]
                if not len(active):
                    break
        steps = np.full((n, count), -2, np.int32)  # ids in order of their last character, -2 where no piece ends
        live, end = np.arange(count), lengths.copy()
        while len(live):
            ids = piece[end, live]
            code = points[end - 1, live].astype(np.int64)
            steps[end - 1, live] = np.where(ids < 0, self.ascii_ids[np.minimum(code, 128)], ids)
            end = end - last[end, live]
            live, end = live[end > 0], end[end > 0]
        return [None if -1 in column else [x for x in column if x >= 0] for column in steps.T.tolist()]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of some ids; the space before a text's first word belongs to them."""
        return b"".join(map(self.text.__getitem__, ids.tolist()))

    def score(self, ids: np.ndarray) -> int:
        return int(self.scores[ids].sum())


class PieceWords(WordCache):
    """Words with their space mark, for texts with single spaces between words."""

    def __init__(self, path: str):
        super().__init__(path)
        self.model = PieceModel.shared(path)

    def split(self, texts: pa.Array) -> pa.Array:
        return pc.split_pattern(texts, " ")

    def encode_words(self, words: list[str]) -> list[list[int]]:
        return self.model.segment_many([MARK + word for word in words])

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        # Runs of spaces are one unit with the word after them: such texts are split here.
        plain = iter(super().encode(texts))
        runs = pc.fill_null(pc.match_substring_regex(texts, "^ |  | $|^$"), True).to_pylist()
        for i, irregular in enumerate(runs):
            ids = next(plain)
            if irregular:
                text = texts[i].as_py()
                units = _WORD.findall(MARK + text.replace(" ", MARK)) if text else []
                distinct = list(dict.fromkeys(units))
                known = dict(zip(distinct, self.model.segment_many(distinct)))
                ids = np.array([x for unit in units for x in known[unit]], np.uint32)
            yield ids


def outer_cuts(text: str, limit: int | None = None) -> tuple[int, int] | None:
    """First and last position up to `limit` where every segmentation has a boundary: before a space mark that follows something else."""
    last = len(text[: text.rfind(MARK, 0, limit) + 1].rstrip(MARK))
    return (_CUT.search(text).start() + 1, last) if last else None


def _middles(words: PieceWords, texts: list[str]) -> list[np.ndarray]:
    """Ids of whole words, the first one of a text with its mark."""
    return list(words.encode(pa.array([text[1:].replace(MARK, " ") for text in texts], pa.large_string())))


def transfers(words: PieceWords, chunks: list[tuple[str, str]]) -> list[np.ndarray]:
    """For chunks and what follows each: best sums from each state at its start (row) to each state at its end (column)."""
    model = words.model
    size = model.reach
    outer = [outer_cuts(body) for body, _ in chunks]
    middles = _middles(words, [body[slice(*cut)] if cut else "" for (body, _), cut in zip(chunks, outer)])
    made = []
    for (body, ahead), cut, middle in zip(chunks, outer, middles):
        matrix = np.full((size, size), NONE, np.int64)
        made.append(matrix)
        if not cut:
            for a in range(min(size, len(body) + 1)):
                matrix[a] = _ends(model, body[a:], ahead)
            continue
        first, last = cut
        head = np.full(size, NONE, np.int64)
        for a in range(min(size, first + 1)):
            best, _ = model.forward(body[a:first], first - a)
            head[a] = best[-1]
        tail = _ends(model, body[last:], ahead)
        both = (head[:, None] != NONE) & (tail[None, :] != NONE)
        whole = model.score(middle.astype(np.int64))
        matrix[:] = np.where(both, np.where(both, head[:, None], 0) + whole + np.where(both, tail[None, :], 0), NONE)
    return made


def _ends(model: PieceModel, body: str, ahead: str) -> np.ndarray:
    """Best sums of segmentations that begin with `body` and whose last piece ends b characters behind it."""
    text = body + ahead[: model.reach - 1]
    best, _ = model.forward(text, len(body))
    ends = np.full(model.reach, NONE, np.int64)
    found = best[len(body) : len(body) + model.reach]
    ends[: len(found)] = found
    return ends


def traces(words: PieceWords, chunks: list[tuple[str, str, int, int]]) -> list[np.ndarray]:
    """For chunks, what follows each and the states at both its ends: ids of the pieces that begin in it."""
    model = words.model
    texts = [(body[begin:] + ahead[:end], len(body) - begin) for body, ahead, begin, end in chunks]
    outer = [outer_cuts(text, n) for text, n in texts]
    middles = _middles(words, [text[slice(*cut)] if cut else "" for (text, _), cut in zip(texts, outer)])
    found = []
    for (text, n), cut, middle in zip(texts, outer, middles):
        if not cut:
            found.append(np.array(model.segment(text, n), np.uint32))
            continue
        head, tail = model.segment(text[: cut[0]]), model.segment(text[cut[1] :], n - cut[1])
        found.append(np.concatenate([np.array(head, np.uint32), middle, np.array(tail, np.uint32)]))
    return found


def combine(matrices: Iterable[np.ndarray]) -> np.ndarray:
    """Max-plus product, in order."""
    product = None
    for matrix in matrices:
        if product is None:
            product = matrix
            continue
        sums = np.where((product == NONE)[:, :, None] | (matrix == NONE)[None, :, :], NONE, product[:, :, None] + matrix[None, :, :])
        product = sums.max(axis=1)
    return product


def states(matrices: list[np.ndarray], begin: int, end: int) -> list[int]:
    """States at all boundaries of neighbouring matrices on a best path from `begin` to `end`."""
    reached = [np.where(np.arange(len(matrices[0])) == begin, 0, NONE)]
    for matrix in matrices:
        sums = np.where((reached[-1] == NONE)[:, None] | (matrix == NONE), NONE, reached[-1][:, None] + matrix)
        reached.append(sums.max(axis=0))
    path = [end]
    for before, matrix in zip(reached[-2::-1], matrices[::-1]):
        into = matrix[:, path[-1]]
        path.append(int(np.where((before == NONE) | (into == NONE), NONE, before + into).argmax()))
    return path[::-1]


_OUT = "doc_id bigint, chunk bigint, chunks bigint, start bigint, n_chars bigint, ids array<int>, score bigint"
_CHUNK = "uid bigint, doc_id bigint, node bigint, chunks bigint, start bigint, body string, ahead string, matrix binary"


def _short(path: str):
    def encoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = PieceWords.shared(path)
        for batch in batches:
            texts = batch.column(2)
            ids = list(words.encode(texts))
            lengths = pc.fill_null(pc.utf8_length(texts), 0).cast(pa.int64())
            yield _rows(batch.column(1), [0] * len(ids), [1] * len(ids), [0] * len(ids), lengths, ids, words.model)
            release()

    return encoded


def _rows(doc_id, chunk, chunks, start, n_chars, ids: list[np.ndarray], model: PieceModel) -> pa.RecordBatch:
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])]).astype(np.int32)
    flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
    scores = [model.score(i.astype(np.int64)) for i in ids]
    longs = [pa.array(c, pa.int64()) for c in (chunk, chunks, start, n_chars)]
    return pa.RecordBatch.from_arrays(
        [doc_id, *longs, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)), pa.array(scores, pa.int64())],
        names=["doc_id", "chunk", "chunks", "start", "n_chars", "ids", "score"],
    )


def _chunked(path: str, chars: int):
    names = [f.split()[0] for f in _CHUNK.split(", ")]

    def chunks_of(batch: pa.RecordBatch, reach: int) -> Iterator[tuple]:
        for uid, doc_id, text in zip(*(batch.column(i) for i in range(3))):
            marked = MARK + text.as_py().replace(" ", MARK)
            number = -(-len(marked) // chars)
            for k in range(number):
                body, ahead = marked[k * chars : (k + 1) * chars], marked[(k + 1) * chars : (k + 1) * chars + reach - 1]
                yield uid.as_py(), doc_id.as_py(), k, number, max(0, k * chars - 1), body, ahead

    def chunked(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = PieceWords.shared(path)
        for batch in batches:
            rows = chunks_of(batch, words.model.reach)
            while block := list(islice(rows, _BLOCK)):
                made = transfers(words, [row[-2:] for row in block])
                columns = [*zip(*block), [matrix.tobytes() for matrix in made]]
                yield pa.RecordBatch.from_pydict(dict(zip(names, columns)), schema=_CHUNK_ARROW)
            release()

    return chunked


_CHUNK_ARROW = pa.schema(
    [(f.split()[0], {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}[f.split()[1]]) for f in _CHUNK.split(", ")]
)


def _matrix(data: bytes, reach: int) -> np.ndarray:
    return np.frombuffer(data, np.int64).reshape(reach, reach)


def _combined(reach: int):
    def merged(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "uid", "above"):
            uid, above = rows.column("uid").to_numpy(), rows.column("above").to_numpy()
            edge = np.union1d(bounds(uid), bounds(above))
            data = rows.column("matrix").to_pylist()
            made = [combine(_matrix(m, reach) for m in data[a:b]).tobytes() for a, b in zip(edge[:-1], edge[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(uid[edge[:-1]]), pa.array(above[edge[:-1]]), pa.array(made, pa.binary())], names=["uid", "node", "matrix"])

    return merged


def _placed(reach: int):
    def placed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, "uid", "above"):
            uid, above, node, begin, end = (rows.column(c).to_numpy() for c in ("uid", "above", "node", "begin", "end"))
            edge = np.union1d(bounds(uid), bounds(above))
            data = rows.column("matrix").to_pylist()
            found = [states([_matrix(m, reach) for m in data[a:b]], int(begin[a]), int(end[a])) for a, b in zip(edge[:-1], edge[1:])]
            starts, ends = (np.concatenate([path[cut] for path in found]) for cut in (slice(0, -1), slice(1, None)))
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in (uid, node, starts, ends)], names=["uid", "node", "begin", "end"])

    return placed


def _traced(path: str):
    def traced(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = PieceWords.shared(path)
        for batch in batches:
            column = {name: batch.column(name) for name in batch.schema.names}
            each = zip(*(column[c].to_pylist() for c in ("body", "ahead", "begin", "end")))
            ids = []
            while block := list(islice(each, _BLOCK)):
                ids += traces(words, block)
            # The mark before a text is not one of its characters.
            lengths = pc.subtract(pc.utf8_length(column["body"]).cast(pa.int64()), pc.equal(column["node"], 0).cast(pa.int64()))
            yield _rows(column["doc_id"], column["node"], column["chunks"], column["start"], lengths, ids, words.model)
            release()

    return traced


def encode_pieces(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """Ids of all texts, one row per chunk: doc_id, chunk, chunks, start, n_chars, ids and score; a text's ids are those of its chunks in order."""
    reach = PieceModel.shared(model_path).reach
    if chunk_chars < reach:
        raise ValueError("a chunk must be as long as the longest piece")
    rows = own_columns(docs, {"doc_id": id_col, "text": text_col})
    rows = rows.select(F.monotonically_increasing_id().alias("uid"), F.col("doc_id").cast("bigint"), "text")
    giant = F.coalesce(F.char_length("text") >= chunk_chars, F.lit(False))
    short = rows.where(~giant).mapInArrow(_short(model_path), _OUT)

    chunks = stage(rows.where(giant).mapInArrow(_chunked(model_path, chunk_chars), _CHUNK), "chunks")
    most = chunks.agg(F.max("chunks")).first()[0]
    if not most:
        return short
    levels = [chunks.select("uid", "node", "matrix")]
    while most > 1:
        up = levels[-1].withColumn("above", F.floor(F.col("node") / FAN).cast("bigint"))
        up = up.repartition("uid", "above").sortWithinPartitions("uid", "above", "node")
        levels.append(stage(up.mapInArrow(_combined(reach), "uid bigint, node bigint, matrix binary"), "transfers"))
        most = -(-most // FAN)
    fixed = levels.pop().select("uid", "node", F.lit(0).cast("bigint").alias("begin"), F.lit(0).cast("bigint").alias("end"))
    while levels:
        below = levels.pop().withColumn("above", F.floor(F.col("node") / FAN).cast("bigint"))
        below = below.join(fixed.withColumnRenamed("node", "above"), ["uid", "above"])
        below = below.repartition("uid", "above").sortWithinPartitions("uid", "above", "node")
        fixed = below.mapInArrow(_placed(reach), "uid bigint, node bigint, begin bigint, end bigint")
    long = chunks.drop("matrix").join(fixed, ["uid", "node"]).mapInArrow(_traced(model_path), _OUT)
    return short.unionByName(long)


def digest_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """Of `encode_pieces`, the number of ids, their CRC-32 (as unsigned little-endian 32-bit numbers) and of the bytes they decode to."""

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel.shared(model_path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            offsets, flat = column.offsets.to_numpy(), column.values.to_numpy().astype("<u4")
            parts = [flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
            crcs = [zlib.crc32(ids.tobytes()) for ids in parts]
            decoded = [zlib.crc32(model.decode(ids)) for ids in parts]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "chunk", "chunks", "start", "n_chars")]
            counts = pa.array([len(ids) for ids in parts], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*kept, counts, pa.array(crcs, pa.int64()), pa.array(decoded, pa.int64()), batch.column(batch.schema.get_field_index("score"))],
                names=["doc_id", "chunk", "chunks", "start", "n_chars", "n_ids", "ids_crc32", "decoded_crc32", "score"],
            )

    return encoded.mapInArrow(
        digests, "doc_id bigint, chunk bigint, chunks bigint, start bigint, n_chars bigint, n_ids bigint, ids_crc32 bigint, decoded_crc32 bigint, score bigint"
    )


def decode_pieces(encoded: DataFrame, model_path: str) -> DataFrame:
    """Of `encode_pieces`, the text of every chunk: doc_id, chunk and the bytes its ids decode to.

    A piece may reach over the end of a chunk, and the first chunk begins with the space before
    the first word; the concatenated chunks without that space are the text.
    """

    def decoded(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = PieceModel.shared(model_path)
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("ids"))
            texts = [model.decode(np.array(ids, np.int64)) for ids in column.to_pylist()]
            kept = [batch.column(batch.schema.get_field_index(c)) for c in ("doc_id", "chunk")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(texts, pa.binary())], names=["doc_id", "chunk", "bytes"])

    return encoded.mapInArrow(decoded, "doc_id bigint, chunk bigint, bytes binary")
