"""Byte-level BPE as a streaming transducer, and its incremental decoder.

Whether a token at the end of what has been read can still change depends on a bounded number of bytes
to its right: a merge is only upset by an earlier-ranked merge that overlaps it on the right, that one only by a still
earlier one, and so on. ``sufficient_lookahead`` finds the longest such chain in a merge list. The encoder
reads a piece through a window, emits tokens whose end lies at least that far from the window's end, and goes
on from the last emitted one, so memory does not grow with the piece. Short pieces, nearly all, fit the window.

Vocabulary and merges are read where the job is planned and broadcast (a few MB); executors need no file.
"""

from __future__ import annotations

import codecs
import json
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .workers import bounded, map_batches

#: How a text falls into pieces that no merge crosses (a fixed part of the format of these vocabularies).
PIECES = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
#: Between a character and white space no piece goes on, so a text can be cut there.
CUT = r"\P{White_Space}(?=\p{White_Space})"
CHUNK = 1 << 16  # characters split into pieces at once
CACHED_PIECES = 150_000  # encoded pieces kept by a worker; beyond that it starts afresh
LONGEST_CACHED = 64
KEPT_VERDICTS = 400_000  # on neighbouring tokens


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    rest = (b for b in range(256) if chr(b) not in out)
    return out | {chr(256 + i): b for i, b in enumerate(rest)}


class Tables:
    """Merge ranks and token bytes of a vocabulary file in the tokenizers library's JSON form."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model, symbol = spec["model"], byte_symbols()
        vocab = model["vocab"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.bytes_of = {i: bytes(symbol[c] for c in token) for token, i in vocab.items()}
        self.first = [vocab[c] for c, _ in sorted(symbol.items(), key=lambda x: x[1])]
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of |= {i: s.encode() for s, i in self.specials.items()}
        self.width = 1 + max(self.bytes_of)
        self.rank: dict[int, int] = {}
        self.parts: list[tuple[int, int]] = []
        self.made: list[int] = []
        for n, (a, b) in enumerate(pairs):
            left, right = vocab[a], vocab[b]
            self.rank.setdefault(left * self.width + right, n)
            self.parts.append((left, right))
            self.made.append(vocab[a + b])

        self.length = {i: len(b) for i, b in self.bytes_of.items()}
        # A tree of all tokens: (node << 8 | byte) -> node, and the token that ends at a node.
        self.step: dict[int, int] = {}
        self.ends = [-1]
        for token, data in self.bytes_of.items():
            if token in self.specials.values():
                continue
            node = 0
            for byte in data:
                after = self.step.setdefault(node << 8 | byte, len(self.ends))
                if after == len(self.ends):
                    self.ends.append(-1)
                node = after
            self.ends[node] = token

    def merge(self, data: bytes) -> list[int]:
        """Tokens of a short text by the merge list itself: the best-ranked pair, everywhere, until none is left."""
        first, rank, made, width = self.first, self.rank, self.made, self.width
        ids, none = [first[b] for b in data], len(self.made)
        while len(ids) > 1:
            ranks = [rank.get(a * width + b, none) for a, b in zip(ids, ids[1:])]
            best = min(ranks)
            if best == none:
                break
            out, i = [], 0
            while i < len(ids):
                if i < len(ranks) and ranks[i] == best:
                    out.append(made[best])
                    i += 2
                else:
                    out.append(ids[i])
                    i += 1
            ids = out
        return ids


def sufficient_lookahead(tables: Tables) -> int:
    """Bytes right of a token's end that settle it, from the longest chain of overlapping merges of falling rank.

    ``reach`` of a merge (t, y): the bytes of y, and then as far as y's own right edge must be known. The
    right edge of y are y and the symbols its derivation ends with; each may be taken away by a merge
    that ranks before the one which consumed it. Merges are visited by rank, so each looks back only.
    """
    born = {}
    for n, token in enumerate(tables.made):
        born.setdefault(token, n)
    ranks: dict[int, list[int]] = {}
    best: dict[int, list[int]] = {}

    def edge_reach(token: int, limit: int) -> int:
        """Farthest need of ``token``, when a merge ranked ``limit`` is about to consume it."""
        most = 0
        while True:
            if token in ranks and (k := bisect_left(ranks[token], limit)):
                most = max(most, best[token][k - 1])
            n = born.get(token)
            if n is None:
                return most
            token, limit = tables.parts[n][1], n

    for n, (left, right) in enumerate(tables.parts):
        reach = len(tables.bytes_of[right]) + edge_reach(right, n)
        seen = best.setdefault(left, [])
        ranks.setdefault(left, []).append(n)
        seen.append(max(reach, seen[-1] if seen else 0))
    return max((edge_reach(t, len(tables.parts)) for t in tables.bytes_of), default=0)


class Encoder:
    def __init__(self, tables: Tables, lookahead: int):
        import regex

        self.tables = tables
        self.lookahead = lookahead
        self.window = max(1024, 4 * lookahead)
        self.pieces = regex.compile(PIECES).findall
        self.cut = regex.compile(CUT)
        self.special = regex.compile("|".join(map(regex.escape, sorted(tables.specials, key=len, reverse=True)))) if tables.specials else None
        self.cache = _Cache(self.pack)
        self.goes = _Goes(tables)

    def tokens(self, data: bytes) -> list[int]:
        """Tokens of one window, from left to right.

        An encoding is right when each token and each two neighbours encode to themselves, and only one
        sequence is. So the longest token that goes with the one before is taken; where none does, the
        one before gives way to a shorter one. Verdicts on neighbours are kept.
        """
        step, ends, goes, width = self.tables.step, self.tables.ends, self.goes, self.tables.width
        out: list[int] = []
        tried: list[list[int]] = []  # per token taken: the shorter ones that start at the same place
        at, n, last = 0, len(data), -1
        fits: list[int] | None = None
        while at < n:
            if fits is None:
                fits, state = [], 0
                for byte in data[at:]:
                    state = step.get(state << 8 | byte)
                    if state is None:
                        break
                    if ends[state] >= 0:
                        fits.append(ends[state])
            while fits:
                token = fits.pop()
                if goes[last * width + token if last >= 0 else ~token]:
                    out.append(token)
                    tried.append(fits)
                    at += self.tables.length[token]
                    last, fits = token, None
                    break
            else:
                at -= self.tables.length[out.pop()]
                fits = tried.pop()
                last = out[-1] if out else -1
        return out

    def stream(self, data: bytes) -> Iterator[int]:
        """Tokens of a piece of any length, through a window."""
        start, length_of = 0, self.tables.bytes_of
        while start < len(data):
            end = min(len(data), start + self.window)
            tokens = self.tokens(data[start:end])
            settled = end if end == len(data) else end - self.lookahead
            for token in tokens:
                if start + len(length_of[token]) > settled:
                    break
                start += len(length_of[token])
                yield token

    def pack(self, piece: str) -> bytes:
        data = piece.encode()
        if len(data) <= self.window:
            return np.array(self.tokens(data), "<u4").tobytes()
        return np.fromiter(self.stream(data), "<u4").tobytes()

    def segments(self, text: str) -> Iterator[str | int]:
        """Parts of a text that are split into pieces on their own, and the special tokens between them."""
        spans = [*((m.start(), m.end(), self.tables.specials[m.group()]) for m in self.special.finditer(text))] if self.special else []
        low = 0
        for start, end, token in [*spans, (len(text), len(text), None)]:
            while low < start:
                high = start
                if start - low > CHUNK and (m := self.cut.search(text, low + CHUNK, start)):
                    high = m.end()
                yield text[low:high]
                low = high
            if token is not None:
                yield token
            low = end

    def encode(self, text: str) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        cache = self.cache
        out = []
        for part in self.segments(text):
            if isinstance(part, int):
                out.append(np.array([part], "<u4").tobytes())
            else:
                out.append(b"".join(map(cache.__getitem__, self.pieces(part))))
                if len(cache) > CACHED_PIECES:
                    cache.clear()
        return b"".join(out)


class _Goes(dict):
    """Whether two tokens (a * width + b), or one (~a), encode to themselves."""

    def __init__(self, tables: Tables):
        self.tables = tables

    def __missing__(self, key: int) -> bool:
        want = [~key] if key < 0 else [*divmod(key, self.tables.width)]
        out = self.tables.merge(b"".join(self.tables.bytes_of[i] for i in want)) == want
        if len(self) > KEPT_VERDICTS:
            self.clear()
        self[key] = out
        return out


class _Cache(dict):
    def __init__(self, pack):
        self.pack = pack

    def __missing__(self, piece: str) -> bytes:
        out = self.pack(piece)
        if len(piece) <= LONGEST_CACHED:
            self[piece] = out
        return out


class Decoder:
    """Byte-to-text state machine: holds at most the bytes of one unfinished character between two calls."""

    def __init__(self, tables: Tables):
        self.bytes_of = tables.bytes_of

    def decode(self, ids: np.ndarray) -> str:
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        out = [
            machine.decode(b"".join(map(self.bytes_of.__getitem__, ids[i:i + CHUNK].tolist())))
            for i in range(0, len(ids), CHUNK)
        ]
        return "".join([*out, machine.decode(b"", True)])


@lru_cache(2)
def _tables(text: str) -> Tables:
    return Tables(text)


@lru_cache(2)
def _encoder(text: str, lookahead: int) -> Encoder:
    return Encoder(_tables(text), lookahead)


def encode(docs: DataFrame, vocabulary: str, keep: list[str], text: str = "text", packed: bool = False) -> DataFrame:
    """Columns ``keep`` of every row plus ``_ids`` (array<int>, or packed bytes) and ``_n_tokens``.

    A null text is encoded like an empty one, to no tokens. Rows are encoded one by one: repeated rows give equal rows.
    """
    spark = docs.sparkSession
    with open(vocabulary, encoding="utf-8") as file:
        source = file.read()
    shared = spark.sparkContext.broadcast((source, sufficient_lookahead(_tables(source))))
    rows = docs.select(F.struct(*[F.col(f"`{k}`") for k in keep]).alias("_row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType())
    schema = T.StructType([rows.schema["_row"], T.StructField("_ids", kind), T.StructField("_n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(*shared.value)
        for whole in batches:
            for batch in bounded(whole, "_text"):
                ids = [encoder.encode(t) for t in batch["_text"].to_pylist()]
                counts = np.array([len(x) // 4 for x in ids], np.int64)
                if packed:
                    column = pa.array(ids, pa.binary())
                else:
                    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                    column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))
                yield pa.RecordBatch.from_arrays([batch["_row"], column, pa.array(counts)], names=["_row", "_ids", "_n_tokens"])

    return map_batches(rows, run, schema).select(*[F.col(f"_row.`{k}`").alias(k) for k in keep], "_ids", "_n_tokens")


def decode(tokens: DataFrame, vocabulary: str, keep: list[str], ids: str = "_ids") -> DataFrame:
    """Columns ``keep`` plus ``_text``: the text of packed ids. Bytes that are no UTF-8 become U+FFFD; null ids give an empty text."""
    with open(vocabulary, encoding="utf-8") as file:
        shared = tokens.sparkSession.sparkContext.broadcast(file.read())
    rows = tokens.select(F.struct(*[F.col(f"`{k}`") for k in keep]).alias("_row"), F.coalesce(F.col(f"`{ids}`"), F.lit(b"")).alias("_ids"))
    schema = T.StructType([rows.schema["_row"], T.StructField("_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(_tables(shared.value))
        for whole in batches:
            for batch in bounded(whole, "_ids"):
                texts = [decoder.decode(np.frombuffer(x, "<u4")) for x in batch["_ids"].to_pylist()]
                yield pa.RecordBatch.from_arrays([batch["_row"], pa.array(texts, pa.string())], names=["_row", "_text"])

    return map_batches(rows, run, schema).select(*[F.col(f"_row.`{k}`").alias(k) for k in keep], "_text")


def digest(docs: DataFrame, vocabulary: str) -> DataFrame:
    """The columns of query op5: hashes of the ids, and of the text that they decode to."""
    coded = encode(docs, vocabulary, ["doc_id"], packed=True)
    coded = coded.select("doc_id", F.col("_n_tokens").alias("n_tokens"), F.sha2("_ids", 256).alias("ids_sha256"), "_ids")
    back = decode(coded, vocabulary, ["doc_id", "n_tokens", "ids_sha256"])
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2("_text", 256).alias("decoded_sha256"))
