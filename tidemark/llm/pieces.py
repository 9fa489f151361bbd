"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

A text gets a leading meta space, its spaces become meta spaces, and adjacent symbols are merged
from a score-ordered agenda (highest score first, leftmost first among equals) as long as the pair
is a piece. Short cuts are merged together, with their agendas as rows of a matrix. Characters outside the vocabulary fall back to bytes. No piece holds a meta space
after another character, so merges never cross such a place: texts are cut there and each
distinct cut is encoded once per task. Every new cut is checked against the sentencepiece library,
one call per Arrow batch; a difference is an error.

Defined results: a null text counts as empty; an empty text has the end id only; repeated rows are
encoded each; columns other than the two named are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import read_table, small_batches

META = "▁"
CACHED_CUTS = 100_000
BATCH_BYTES = 2 << 20
POSITION = (1 << 40) - 1
WIDTHS = (6, 9, 12, 16, 24, 40)
MATRIX_ROWS = 2048
NO_PIECE = np.int32(2**31 - 1)


class Vocabulary:
    """Pieces of a model and the agenda over them."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = self.library.get_piece_size()
        self.names = [self.library.id_to_piece(i) for i in range(size)]
        self.end = self.library.eos_id()
        self.ids, self.bytes = {}, {}
        for i, name in enumerate(self.names):
            if self.library.is_byte(i):
                self.bytes[i] = int(name[3:-1], 16)
            elif not self.library.is_control(i) and not self.library.is_unknown(i):
                self.ids[name] = i
                if META in name.lstrip(META):
                    raise ValueError(f"piece {name!r} holds a meta space inside: cuts would be wrong")
        self.byte_ids = {value: i for i, value in self.bytes.items()}
        self.numerals = [str(i) for i in range(size)]
        # text of a plain piece; None for bytes, "" for control pieces
        self.surfaces = [None if i in self.bytes else "" for i in range(size)]
        for name, i in self.ids.items():
            self.surfaces[i] = name.replace(META, " ")
        scores = sorted({self.library.get_score(i) for i in self.ids.values()}, reverse=True)
        place = {score: k for k, score in enumerate(scores)}  # equal scores share a place
        self.order = {name: place[self.library.get_score(i)] for name, i in self.ids.items()}
        # for cuts that are merged together: characters, pairs and places as arrays
        self.pad = size  # stands for no symbol; greater ids for characters outside the vocabulary
        self.characters = np.arange(size + 1, size + 1 + 0x110000, dtype=np.int32)
        pairs = []
        for name, i in self.ids.items():
            if len(name) == 1:
                self.characters[ord(name)] = i
            for k in range(1, len(name)):
                if name[:k] in self.ids and name[k:] in self.ids:
                    pairs.append((self.ids[name[:k]] << 32 | self.ids[name[k:]], i))
        known = np.array(sorted(pairs) or [(-1, 0)], np.int64)
        self.pair_keys, self.pair_ids = known[:, 0].copy(), known[:, 1].astype(np.int32)
        self.places = np.full(size, NO_PIECE, np.int32)
        for name, i in self.ids.items():
            self.places[i] = self.order[name]

    def merge(self, text: str) -> list[str]:
        """Symbols left when the agenda of adjacent pairs is empty."""
        # the agenda is a heap; an entry is one number: the pair's place by score, its position
        order, parts, n = self.order, list(text), len(text)
        agenda = [order[pair] << 40 | i for i, pair in enumerate(map(add, parts, parts[1:]))
                  if pair in order]
        if not agenda:
            return parts
        heapify(agenda)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while agenda:
            entry = heappop(agenda)
            i = entry & POSITION
            j = after[i]
            if j >= n or not parts[i]:
                continue
            pair = parts[i] + parts[j]
            if order.get(pair) != entry >> 40:
                continue  # a part of the entry's pair has been merged meanwhile
            parts[i], parts[j] = pair, ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                place = order.get(pair + parts[k])
                if place is not None:
                    heappush(agenda, place << 40 | i)
            h = before[i]
            if h >= 0:
                place = order.get(parts[h] + pair)
                if place is not None:
                    heappush(agenda, place << 40 | h)
        return [part for part in parts if part]

    def pair_piece(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(piece, place) of pairs of ids; the place is NO_PIECE where the pair is none."""
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        piece = self.pair_ids[at]
        return piece, np.where(self.pair_keys[at] == key, self.places[piece], NO_PIECE)

    def merge_matrix(self, symbols: np.ndarray) -> np.ndarray:
        """Merge many cuts (rows of ids, padded) together; what has been merged away is padding.

        The agenda of a row holds the place of the pair that starts at each position. Every round
        takes the best pair of each row, the leftmost among equals.
        """
        n, width = symbols.shape
        pad = np.full((n, 1), self.pad, np.int32)
        symbols = np.hstack([symbols, pad])
        agenda = np.hstack([self.pair_piece(symbols[:, :-1], symbols[:, 1:])[1],
                            np.full((n, 1), NO_PIECE, np.int32)])
        after = np.tile(np.arange(1, width + 2, dtype=np.int32), (n, 1))
        before = after - 2
        done, rows = symbols, np.arange(n)
        while len(rows):
            i = agenda.argmin(axis=1)
            r = np.flatnonzero(agenda[np.arange(len(i)), i] != NO_PIECE)
            if len(r) < len(rows) // 2:  # go on with the rows that still have pairs
                done[rows] = symbols
                symbols, agenda, after, before, rows, i = (
                    x[r] for x in (symbols, agenda, after, before, rows, i))
                r = np.arange(len(rows))
            i = i[r]
            j = after[r, i]
            k = after[r, j]
            h = before[r, i]
            new, _ = self.pair_piece(symbols[r, i], symbols[r, j])
            symbols[r, i], symbols[r, j], agenda[r, j] = new, self.pad, NO_PIECE
            after[r, i], before[r, k] = k, i
            agenda[r, i] = self.pair_piece(new, symbols[r, k])[1]
            agenda[r, h] = self.pair_piece(symbols[r, h], new)[1]  # h = -1 is the padding
            if not len(r):
                break
        done[rows] = symbols
        return done

    def with_bytes(self, i: int) -> list[int]:
        if i < self.pad:
            return [i]
        return [self.byte_ids[b] for b in chr(i - self.pad - 1).encode()]

    def encode_cuts(self, cuts: list[str]) -> list[list[int]]:
        """Ids of many cuts: short ones in matrices, by width; the rest one by one."""
        out: list[list[int]] = [[]] * len(cuts)
        sizes = np.fromiter(map(len, cuts), np.int64, len(cuts))
        codes = np.frombuffer("".join(cuts).encode("utf-32-le"), np.uint32)
        ids = np.append(self.characters[codes], np.int32(self.pad))
        starts = np.cumsum(sizes) - sizes
        least = 0
        for width in WIDTHS:
            fitting = np.flatnonzero((sizes > least) & (sizes <= width))
            least = width
            at = np.arange(width)
            for first in range(0, len(fitting), MATRIX_ROWS):
                rows = fitting[first:first + MATRIX_ROWS]
                inside = at < sizes[rows, None]
                symbols = ids[np.where(inside, starts[rows, None] + at, len(ids) - 1)]
                merged = self.merge_matrix(symbols)
                held = merged != self.pad
                flat, ends = merged[held].tolist(), np.cumsum(held.sum(axis=1)).tolist()
                start = 0
                for row, end in zip(rows.tolist(), ends, strict=True):
                    out[row] = flat[start:end]
                    start = end
                for row in rows[(merged > self.pad).any(axis=1)].tolist():
                    out[row] = [b for i in out[row] for b in self.with_bytes(i)]
        for row in np.flatnonzero(sizes > WIDTHS[-1]).tolist():
            out[row] = self.encode_cut(cuts[row])
        return out

    def encode_cut(self, text: str) -> list[int]:
        ids = []
        for part in self.merge(text):
            found = self.ids.get(part)
            if found is None:
                ids.extend(self.byte_ids[b] for b in part.encode())
            else:
                ids.append(found)
        return ids

    def decode_pieces(self, ids: list[int]) -> str:
        """Surface of ids, without removing the leading space of a text."""
        parts = [self.surfaces[i] for i in ids]
        if None not in parts:
            return "".join(parts)
        out, run = [], bytearray()
        for i, part in zip(ids, parts, strict=True):
            if part is None:
                run.append(self.bytes[i])
            else:
                out.append(run.decode(errors="replace"))
                run.clear()
                out.append(part)
        return "".join(out) + run.decode(errors="replace")

    def decode(self, ids: list[int]) -> str:
        """Text of ids; control ids have no surface and one leading space is dropped."""
        return self.decode_pieces(ids).removeprefix(" ")


CUT = re.compile(f"{META}+[^{META}]*")


def cuts_of(text: str) -> list[str]:
    return CUT.findall(META + text.replace(" ", META)) if text else []


class Encoder:
    """Encodes texts by their cuts, which it keeps while they repeat."""

    def __init__(self, model: bytes, most: int = CACHED_CUTS):
        self.vocabulary = Vocabulary(model)
        self.most = most
        self.kept: dict[str, tuple[list[int], str, str]] = {}

    def learn(self, texts: list[list[str]]) -> None:
        """Encode the cuts not seen yet, and check them against the library."""
        if len(self.kept) > self.most:
            self.kept.clear()
        new = list({cut for cuts in texts for cut in cuts if cut not in self.kept})
        if not new:
            return
        v = self.vocabulary
        own = v.encode_cuts(new)
        # The library puts the leading meta space back itself.
        theirs = v.library.encode([cut[1:] for cut in new], num_threads=1)
        texts_back = v.library.decode(own, num_threads=1)
        for cut, ids, expected, back in zip(new, own, theirs, texts_back, strict=True):
            surface = v.decode_pieces(ids)
            if cut != META and ids != expected or surface.removeprefix(" ") != back:
                raise ValueError(f"{cut[:80]!r}: ids {ids[:20]} differ from the library's {expected[:20]}")
            self.kept[cut] = (ids, " ".join([v.numerals[i] for i in ids]), surface)


def encode(
    df: DataFrame,
    model: bytes,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    ids: bool = True,
    decoded: bool = True,
    cached_cuts: int = CACHED_CUTS,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """Ids (ending with the end id) and decoded text of every text, with their digests.

    ``ids`` and ``decoded`` say whether the arrays and texts themselves are returned. A task
    remembers about ``cached_cuts`` cuts (half a kilobyte each) and takes texts of ``batch_bytes``
    at a time.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)  # one vocabulary file, fixed size
    fields = [("ids", pa.list_(pa.int32()))] * ids + [("decoded", pa.string())] * decoded
    kind = df.schema[id_col].dataType.simpleString()
    schema = ", ".join(
        [f"{id_col} {kind}", "n_tokens long", "ids_sha256 string", "decoded_sha256 string"]
        + ["ids array<int>"] * ids
        + ["decoded string"] * decoded
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, cached_cuts)
        end = encoder.vocabulary.end
        for batch in small_batches(batches, batch_bytes):
            texts = [cuts_of(t or "") for t in batch.column(1).to_pylist()]
            encoder.learn(texts)
            n, id_hash, text_hash, all_ids, all_texts = [], [], [], [], []
            for cuts in texts:
                rows = [encoder.kept[cut] for cut in cuts]
                n.append(sum(len(r[0]) for r in rows) + 1)
                joined = " ".join([r[1] for r in rows] + [str(end)])
                id_hash.append(hashlib.sha256(joined.encode()).hexdigest())
                text = "".join([r[2] for r in rows]).removeprefix(" ")
                text_hash.append(hashlib.sha256(text.encode()).hexdigest())
                if ids:
                    all_ids.append([i for r in rows for i in r[0]] + [end])
                if decoded:
                    all_texts.append(text)
            columns = [batch.column(0), pa.array(n, pa.int64()), pa.array(id_hash, pa.string()),
                       pa.array(text_hash, pa.string())]
            for name, arrow in fields:
                columns.append(pa.array(all_ids if name == "ids" else all_texts, arrow))
            yield pa.RecordBatch.from_arrays(columns, [
                "id", "n_tokens", "ids_sha256", "decoded_sha256", *(name for name, _ in fields)])

    return df.select(id_col, F.col(text_col).cast("string")).mapInArrow(run, schema)


def decode(df: DataFrame, model: bytes, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Text of every array of ids; a null array counts as empty."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shared.value)
        for batch in small_batches(batches):
            texts = [vocabulary.decode([i for i in x or [] if i is not None])
                     for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())],
                                             ["id", "text"])

    return df.select(id_col, ids_col).mapInArrow(run, f"{id_col} {kind}, text string")


def model_bytes(path: str | None = None) -> bytes:
    """Bytes of a vocabulary file, read on the driver."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    with open(path, "rb") as file:
        return file.read()


def op9_sentencepiece(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """Ids and round trip of all documents, as digests."""
    docs = read_table(spark, sf_dir, "documents")
    return encode(docs, model_bytes(path), ids=False, decoded=False, cached_cuts=250_000,
                  batch_bytes=8 << 20)
