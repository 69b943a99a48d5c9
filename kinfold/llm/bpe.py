"""Byte-level BPE encoding and decoding through a distinct-word table.

Plan
----
1. Split, once: documents are packed into chunks of bounded text. A chunk becomes one row with its distinct words and, for
   each document, the places of its words in that list, and rows with the same distinct words by bucket.
2. One shuffle carries both: the words go to their bucket's partition (hot words leave a chunk once), the chunk to one of
   its own. Its files are read twice, so texts are split no second time.
3. Word table: a bucket's partition holds each word of that bucket, so each distinct word is encoded once, however many
   chunks use it. The word's ids meet the id-to-piece table, which has the vocabulary's size and lies in every worker, and
   give the decoded word. Ids and decoded words go back to the chunk in the order in which its words came.
4. Join by position: chunk and rows of the word table meet by chunk; a word's ids and decoded text are put at each of its
   places.

A table of words as plain rows would shuffle 44 million rows for 0.5 GB of documents, three times: more than the disk
that the check tool grants, so the rows are packed by chunk and bucket.

Buckets are as many as shuffle partitions, each sent by a number that Spark's hash puts into a partition of its own, and
chunks are spread over the partitions in turn, so that partitions are even at every size. Memory is bounded by the chunk
(`chunk_chars`, or a single longer text) and by `table_words` entries of a bucket's word table; words beyond those are
encoded whenever they come, which changes no result. A chunk's key is a hash of its rows, so a recomputed task makes the
same chunk; should the input come in another order after a loss, so that a chunk's words find no ids, they are encoded in
place and counted in `n_in_place` (0 otherwise).

Defined cases: null text counts as empty; empty text has no ids, n_tokens 0 and the digests of the empty string; rows
that repeat give repeated results; a null doc_id stays null; very long texts are a chunk of their own; other columns are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import release, releasing, table

#: Splits text into words as the vocabulary's byte-level pre-tokenizer does (fixed value).
WORD_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
DIGEST_SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, n_in_place long"
FULL_SCHEMA = "doc_id long, ids array<int>, decoded string"
SPLIT_SCHEMA = "dest long, chunk long, payload binary"
IDS_SCHEMA = "chunk long, payload binary"
#: Set in the keys of chunks, never in those of buckets.
CHUNK_BIT = 1 << 62


def _class(kind: str, below: int) -> str:
    """Character class (without brackets) of the characters below `below` whose category starts with `kind`."""
    return "".join(re.escape(chr(c)) for c in range(below) if unicodedata.category(chr(c))[0] == kind)


#: Texts without a character from here on are split by a pattern of plain character classes, which is faster.
WIDE = 0x220
_L, _N, _S = _class("L", WIDE), _class("N", WIDE), r"\t-\r\x20\x85\xa0"
_NARROW = re.compile(rf" ?[{_L}]+|'(?:s|t|re|ve|m|ll|d)| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_has_wide = re.compile(f"[{chr(WIDE)}-\U0010ffff]").search


class Vocabulary:
    """One tokenizer file: word splitter, word encoder and id-to-piece table."""

    _loaded: dict[str, Vocabulary] = {}

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = {token.content: i for i, token in self.tokenizer.get_added_tokens_decoder().items()}
        self.find_words = regex.compile(WORD_PATTERN).findall
        self.split_special = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")").split if self.special else None
        self.pre_tokenize = self.tokenizer.pre_tokenizer.pre_tokenize_str
        byte_of = byte_alphabet()
        pieces = {i: bytes(byte_of[c] for c in piece) for piece, i in self.tokenizer.get_vocab(with_added_tokens=False).items()}
        pieces |= {i: s.encode() for s, i in self.special.items()}
        self.pieces = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.decimals = [str(i) for i in range(len(self.pieces))]

    @cached_property
    def late(self) -> frozenset[str]:
        """Letters and digits that Unicode took in late may be unknown to the library: texts with them are split by it."""
        import regex

        everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        return frozenset(c for c in regex.findall(r"[\p{L}\p{N}]", everything) if unicodedata.ucd_3_2_0.category(c)[0] not in "LN")

    @classmethod
    def at(cls, path: str) -> Vocabulary:
        if path not in cls._loaded:
            cls._loaded[path] = cls(path)
        return cls._loaded[path]

    def words(self, text: str) -> list[str]:
        if self.split_special is None or not any(s in text for s in self.special):
            return self._plain(text)
        return [w for part in self.split_special(text) for w in ([part] if part in self.special else self._plain(part))]

    def _plain(self, text: str) -> list[str]:
        if text.isascii() or not _has_wide(text):
            return _NARROW.findall(text)
        if self.late.isdisjoint(text):
            return self.find_words(text)
        return [text[a:b] for _, (a, b) in self.pre_tokenize(text)]

    def encode(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(words, add_special_tokens=False)]


def byte_alphabet() -> dict[str, int]:
    """Printable stand-ins of the 256 bytes: printable Latin-1 stands for itself, the others take characters from 256 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def _chunks(batches: Iterator[pa.RecordBatch], chunk_chars: int) -> Iterator[tuple[int, list, list[str]]]:
    """(hash, doc_ids, texts) of bounded runs of rows."""
    ids, texts, size, digest = [], [], 0, hashlib.blake2b(digest_size=8)
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            text = text.as_py() or ""
            if texts and size + len(text) > chunk_chars:
                yield int.from_bytes(digest.digest()), ids, texts
                ids, texts, size, digest = [], [], 0, hashlib.blake2b(digest_size=8)
            digest.update(f"{doc_id}:{len(text)}:".encode())
            digest.update(text.encode("utf-8", "surrogatepass"))
            ids.append(doc_id)
            texts.append(text)
            size += len(text) + 16
    if texts:
        yield int.from_bytes(digest.digest()), ids, texts


def _pack(value) -> bytes:
    return zlib.compress(json.dumps(value, ensure_ascii=False, separators=(",", ":")).encode("utf-8", "surrogatepass"), 6)


def _unpack(payload: bytes):
    return json.loads(zlib.decompress(payload).decode("utf-8", "surrogatepass"))


def _table_bytes(**columns: pa.Array) -> bytes:
    sink, rows = pa.BufferOutputStream(), pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))) as writer:
        writer.write_batch(rows)
    return sink.getvalue().to_pybytes()


def _table_of(payload: bytes) -> pa.Table:
    with pa.ipc.open_stream(payload) as reader:
        return reader.read_all()


def _chunk_payload(ids: list, places: list[np.ndarray], words: list[str]) -> bytes:
    """Documents, word places and distinct words of a chunk. The places' four bytes lie apart, which halves the upper ones."""
    flat = np.concatenate(places).astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    documents = _table_bytes(doc_id=pa.array(ids, pa.int64()), n=pa.array([len(p) for p in places], pa.int64()))
    rest = _table_bytes(word=pa.array(words, pa.string()))
    flat = _table_bytes(flat=pa.array([flat], pa.large_binary()))
    return len(documents).to_bytes(8) + len(flat).to_bytes(8) + documents + flat + rest


def _chunk_of(payload: bytes) -> tuple[list, list[np.ndarray], list[str]]:
    a = 16 + int.from_bytes(payload[:8])
    b = a + int.from_bytes(payload[8:16])
    documents, flat = _table_of(payload[16:a]), _table_of(payload[a:b]).column("flat")[0].as_py()
    places = np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)
    ends = np.cumsum(documents.column("n").to_numpy())
    return documents.column("doc_id").to_pylist(), np.split(places, ends[:-1]), _table_of(payload[b:]).column("word").to_pylist()


def partition_of(x: int, n: int) -> int:
    """The partition of n that Spark's hash of the long x (Murmur3, seed 42; fixed values) chooses."""

    def turned(v: int, by: int) -> int:
        return (v << by | v >> 32 - by) & 0xFFFFFFFF

    h = 42
    for word in (x & 0xFFFFFFFF, x >> 32 & 0xFFFFFFFF):
        h = (turned(h ^ turned(word * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
    h ^= 8
    h = (h ^ h >> 16) * 0x85EBCA6B & 0xFFFFFFFF
    h = (h ^ h >> 13) * 0xC2B2AE35 & 0xFFFFFFFF
    h ^= h >> 16
    return (h - (1 << 32) if h >> 31 else h) % n


def bucket_keys(n: int) -> list[int]:
    """For each of n partitions the smallest number that goes there."""
    keys: dict[int, int] = {}
    x = 0
    while len(keys) < n:
        keys.setdefault(partition_of(x, n), x)
        x += 1
    return [keys[p] for p in range(n)]


def chunk_key(digest: int, turn: float, n: int) -> int:
    """A key made from the chunk's hash that goes to the partition at `turn` (0 to 1) of the n."""
    wanted, x = int(turn * n), digest % CHUNK_BIT
    while partition_of(x | CHUNK_BIT, n) != wanted:
        x = (x + 0x9E3779B97F4A7C15) % CHUNK_BIT
    return x | CHUNK_BIT


class Numbers(dict):
    """Word -> number, in order of first appearance."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def _bucket_words(words, buckets: int) -> dict[int, list[str]]:
    """Distinct words by bucket, in their order of first appearance in the chunk, so that a list can be made again."""
    dealt: dict[int, list[str]] = {}
    for w in words:
        dealt.setdefault(zlib.crc32(w.encode("utf-8", "surrogatepass")) % buckets, []).append(w)
    return dealt


def _split(path: str, chunk_chars: int, keys: list[int]):
    """Rows (dest, chunk, payload): a chunk's row has dest = chunk, the words of a bucket have the bucket's key."""

    def run(batches):
        from pyspark import TaskContext

        vocabulary, task = Vocabulary.at(path), TaskContext.get().partitionId()
        for i, (digest, ids, texts) in enumerate(_chunks(batches, chunk_chars)):
            # Steps of two irrationals visit the partitions evenly, whatever the numbers of tasks and of chunks.
            key = chunk_key(digest, (task * 0.7548776662466927 + i * 0.5698402909980532) % 1, len(keys))
            number = Numbers()
            places = [np.fromiter(map(number.__getitem__, vocabulary.words(t)), np.int32) for t in texts]
            dealt = _bucket_words(number, len(keys))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([key, *(keys[b] for b in dealt)], pa.int64()),
                    pa.array([key] * (len(dealt) + 1), pa.int64()),
                    pa.array([_chunk_payload(ids, places, list(number)), *(_pack([b, w]) for b, w in dealt.items())], pa.binary()),
                ],
                names=["dest", "chunk", "payload"],
            )

    return run


def _rows_of(vocabulary: Vocabulary, words: list[str]) -> tuple[list[str], list[str]]:
    """The word table's columns: ids in decimals, and the text that the ids' pieces decode to."""
    decimals, pieces = vocabulary.decimals.__getitem__, vocabulary.pieces.__getitem__
    ids = vocabulary.encode(words)
    return [",".join(map(decimals, x)) for x in ids], [b"".join(map(pieces, x)).decode("utf-8", "replace") for x in ids]


def _word_table(path: str, table_words: int):
    """Encodes and decodes each distinct word of the partition once; a packed word list goes back as its rows, in order.

    A word's decoded text is sent only where it differs from the word.
    """

    def run(batches):
        vocabulary, known, other = Vocabulary.at(path), {}, {}
        for batch in batches:
            out = []
            for payload in batch.column(2):
                bucket, words = _unpack(payload.as_py())
                new = [w for w in words if w not in known]
                ids, decoded = _rows_of(vocabulary, new)
                extra, changed = dict(zip(new, ids, strict=True)), {w: d for w, d in zip(new, decoded, strict=True) if w != d}
                if len(known) + len(new) <= table_words:
                    known |= extra
                    other |= changed
                    extra, changed = known, other
                else:
                    extra, changed = extra | {w: known[w] for w in words if w in known}, other | changed
                out.append(_pack([bucket, ";".join(map(extra.__getitem__, words)), {w: changed[w] for w in words if w in changed} if changed else {}]))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(out, pa.binary())], names=["chunk", "payload"])

    return run


def _place(path: str, buckets: int, full: bool):
    """Joins ids back by position and decodes, for one chunk (or several copies of the same chunk)."""

    def run(chunks: pa.Table, dealt: pa.Table) -> pa.Table:
        release()  # what the chunk before has left
        payload = chunks.column("payload")[0].as_py() if len(chunks) else None
        if payload is None:
            return pa.table({f.split()[0]: [] for f in (FULL_SCHEMA if full else DIGEST_SCHEMA).split(", ")}, schema=_arrow_schema(full))
        doc_ids, places, words = _chunk_of(payload)
        rows_of_bucket = {bucket: (ids.split(";"), other) for bucket, ids, other in (_unpack(p.as_py()) for p in dealt.column("payload"))}
        number, ids_of, decoded_of, in_place = {w: i for i, w in enumerate(words)}, [""] * len(words), list(words), 0
        for bucket, own in _bucket_words(words, buckets).items():
            got, other = rows_of_bucket.pop(bucket, ((), {}))
            if len(got) != len(own):
                got, decoded = _rows_of(Vocabulary.at(path), own)
                other, in_place = dict(zip(own, decoded, strict=True)), in_place + len(own)
            for w, ids in zip(own, got, strict=True):
                ids_of[number[w]] = ids
            for w, text in other.items():
                decoded_of[number[w]] = text
        del number, rows_of_bucket
        count_of = np.fromiter((ids.count(",") + 1 for ids in ids_of), np.int64, len(ids_of))
        out: list[list] = [[], [], []] if full else [[], [], [], [], []]
        for doc_id, place in zip(doc_ids, places, strict=True):
            at = place.tolist()
            ids, decoded = ",".join(map(ids_of.__getitem__, at)), "".join(map(decoded_of.__getitem__, at))
            if full:
                row = (doc_id, list(map(int, ids.split(","))) if at else [], decoded)
            else:
                row = (doc_id, int(count_of[place].sum()), hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest(), in_place)
            for column, value in zip(out, row, strict=True):
                column.append(value)
        # Further rows of the key are copies of the chunk.
        return pa.concat_tables([pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(out, _arrow_schema(full), strict=True)], schema=_arrow_schema(full))] * len(chunks))

    return run


def _arrow_schema(full: bool) -> pa.Schema:
    if full:
        return pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])
    return pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string()), ("n_in_place", pa.int64())])


def encode_decode(docs: DataFrame, path: str, *, full: bool = False, chunk_chars: int = 6_000_000, table_words: int = 2_000_000) -> DataFrame:
    """Token ids of every whole text and the text decoded from them: digests, or with `full` ids and text themselves.

    docs: doc_id, text and any other columns. path: the tokenizer file, at the same place on every executor.
    """
    keys = bucket_keys(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    both = rows.mapInArrow(releasing(_split(path, chunk_chars, keys)), SPLIT_SCHEMA).repartition(len(keys), "dest")
    # A condition that is not deterministic stays above the shuffle, which therefore serves both sides.
    kept = lambda c: both.where(c == (F.monotonically_increasing_id() >= 0))
    ids = kept(F.col("dest") != F.col("chunk")).mapInArrow(releasing(_word_table(path, table_words)), IDS_SCHEMA)
    chunks = kept(F.col("dest") == F.col("chunk"))
    return chunks.groupBy("dest").cogroup(ids.groupBy("chunk")).applyInArrow(_place(path, len(keys), full), FULL_SCHEMA if full else DIGEST_SCHEMA)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
