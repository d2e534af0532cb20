"""Token-ID files: frequency-ranked ids in byte-aligned variable-length code.

Every text is encoded once with a public tokenizer; the ids go to a scratch
table. One pass counts them; then the documents are range partitioned and sorted
by ``doc_id``, ids are replaced by their rank in descending frequency (so that
most take one byte), and each partition becomes one file.

File format (little endian): records of ``doc_id`` (int64), flags (uint32, bit 0:
the doc_id is null), number of values (uint32), number of data bytes (uint32),
then the control bytes and the data bytes. A control byte holds four 2-bit byte
counts less one, lowest bits first; the data bytes are the values' low bytes.
``ranks.parquet`` maps rank to id; ``manifest`` names the committed files with
their document, value and byte counts and their crc32.

Null texts are empty; an empty text is the end id alone. Repeated rows are
written once each; rows of equal doc_id are ordered by a hash of their text;
null doc_ids come first. An empty table gives no files and no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairforge.llm.common import column, frugal, kept_objects, pick, saved, table, tune
from pairforge.llm.shared_files import CommittedFile, drop_temporary, open_stream
from pairforge.session import scratch_path

END_ID = 1
TOKENS_PER_FILE = 1 << 23
MAX_CACHED = 350_000  # pieces: some 85 MB of a Python worker while it tokenizes
JOINED = 1024  # pieces that go to the tokenizer in one string
RUN_CHARS = 1 << 21  # of texts split at once, beyond the last one
HEAD = "<qIII"  # doc_id, flags, values, data bytes
HEAD_BYTES = struct.calcsize(HEAD)

# Texts of these characters only are split here as the tokenizer splits them
# (letters, single digits, runs of others); all other texts go to it whole.
PLAIN = re.compile("[\t\n\r -~À-ÖØ-öø-įı-ſ]*")
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_KIND = np.full(256, _OTHER, np.uint8)  # of the bytes of a plain text in lower case
_KIND[list(b"\t\n\r ")] = _SPACE
_KIND[97:123] = _KIND[128:] = _LETTER  # PLAIN has no other characters beyond ASCII
_KIND[48:58] = _DIGIT


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---- codec ---------------------------------------------------------------

_LENGTHS = np.array([[(c >> (2 * i) & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)
_LOW = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], np.uint32)


def vbyte_encode(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = np.ascontiguousarray(values, "<u4")
    extra = (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    quads = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    quads[: len(v)] = extra
    q = quads.reshape(-1, 4)
    control = q[:, 0] | q[:, 1] << 2 | q[:, 2] << 4 | q[:, 3] << 6
    data = v.view(np.uint8).reshape(-1, 4)[np.arange(4) <= extra[:, None]]
    return control.astype(np.uint8).tobytes(), data.tobytes()


def vbyte_decode(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The n values: lengths by table lookup on the control bytes, then one
    gather of four bytes at each value's place, masked to its length."""
    if n == 0:
        return np.zeros(0, np.uint32)
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    raw = np.frombuffer(data + b"\0\0\0", np.uint8)
    four = np.ndarray((len(raw) - 3,), "<u4", raw, strides=(1,))
    return four[ends - lengths] & _LOW[lengths]


# ---- tokenizing ------------------------------------------------------------


def split_pieces(texts: list[str]) -> tuple[pa.StringArray, np.ndarray]:
    """The tokenizer's pieces ('s|'t|'re|'ve|'m|'ll|'d|letters|digit|others) of
    plain texts, one after another, and each text's bounds among them."""
    raw = [t.lower().encode() for t in texts]
    data = np.frombuffer(b"\n".join([*raw, b"\n\n"]), np.uint8)  # so that two bytes follow each quote
    kind = _KIND[data]
    begin = kind != _SPACE
    begin[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    q = np.flatnonzero(begin & (data == ord("'")))
    one, two = data[q + 1], data[q + 2]
    size = np.isin(one, list(b"stmd")) + 2 * ((two == ord("e")) & ((one == ord("r")) | (one == ord("v"))) | (two == ord("l")) & (one == ord("l")))
    q, size = q[size > 0], size[size > 0]
    begin[q + 1] = False
    after = q + 1 + size
    begin[after] |= kind[after] == _LETTER
    starts = np.cumsum([0, *(len(x) + 1 for x in raw)])
    bounds = np.searchsorted(np.flatnonzero(begin), starts)
    solid = kind != _SPACE
    first = np.flatnonzero(begin[solid])
    solid = data[solid]
    offsets = np.append(first, len(solid)).astype(np.int32)
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(solid)), bounds


def _strings(pieces: pa.StringArray) -> list[str]:
    """``pieces.to_pylist()``, faster; they have no white space."""
    one = pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces)
    return pc.binary_join(one, " ")[0].as_py().split()


class _Index(dict):
    """Numbers new pieces as they are looked up."""

    def __init__(self):
        super().__init__()
        self.pending: list[str] = []

    def __missing__(self, piece: str) -> int:
        i = self[piece] = len(self)
        self.pending.append(piece)
        return i


class Encoder:
    """Ids of texts, equal to the tokenizer's own. Pieces that the tokenizer
    treats independently are encoded once while they stay in a bounded cache."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit, Sequence

        # one tokenizer for whole texts and for pieces. Pieces are in lower case and
        # of PLAIN characters, so its normalizer would leave them as they are, and
        # they are split already: it gets them without both steps
        self.tok = Tokenizer.from_file(path)
        self.whole = self.tok.normalizer, self.tok.pre_tokenizer
        self.split = None, Sequence([CharDelimiterSplit(" "), self.tok.pre_tokenizer[1]])
        suffix = self.tok.model.end_of_word_suffix
        self.last = np.zeros(self.tok.get_vocab_size(), bool)
        self.last[[i for token, i in self.tok.get_vocab(with_added_tokens=False).items() if token.endswith(suffix)]] = True
        self._clear()

    def _clear(self) -> None:
        self.index, self.ids = _Index(), np.zeros(0, np.uint32)
        self.offset, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _shrink(self) -> None:
        """Forget the pieces learned last, beyond the bound: those seen first are
        the frequent ones."""
        over = len(self.index) - MAX_CACHED
        if over > 0:
            for _ in range(over):
                self.index.popitem()
            self.offset, self.length = self.offset[:MAX_CACHED], self.length[:MAX_CACHED]
            self.ids = self.ids[: self.offset[-1] + self.length[-1]]

    def _encode_whole(self, texts: list[str]) -> list[list[int]]:
        self.tok.normalizer, self.tok.pre_tokenizer = self.whole
        return [self.tok.encode_batch_fast([t], add_special_tokens=False)[0].ids for t in texts]

    def _learn(self) -> None:
        """Encode the new pieces, some in a string; the tokenizer marks the last id
        of a piece (``</w>``)."""
        new, step = self.index.pending, JOINED
        self.tok.normalizer, self.tok.pre_tokenizer = self.split
        got = [self.tok.encode_batch_fast([" ".join(new[k : k + step])], add_special_tokens=False)[0].ids for k in range(0, len(new), step)]
        ids = np.concatenate([np.array(x, np.uint32) for x in got])
        stop = np.flatnonzero(self.last[ids]) + 1
        if len(stop) != len(new) or stop[-1] != len(ids):
            raise ValueError(f"{len(new)} pieces gave {len(stop)} last ids")
        new.clear()
        self.offset = np.concatenate([self.offset, len(self.ids) + np.append(0, stop[:-1])])
        self.length = np.concatenate([self.length, np.diff(stop, prepend=0)])
        self.ids = np.concatenate([self.ids, ids])

    def _encode_plain(self, texts: list[str]) -> list[np.ndarray]:
        self._shrink()
        pieces, bounds = split_pieces(texts)
        coded = pieces.dictionary_encode()
        unique = _strings(coded.dictionary)
        known = np.fromiter(map(self.index.__getitem__, unique), np.int64, len(unique))
        if self.index.pending:
            self._learn()
        code = coded.indices.to_numpy()
        length = self.length[known][code]
        ends = np.concatenate([[0], np.cumsum(length)])
        flat = self.ids[np.arange(ends[-1]) + np.repeat(self.offset[known][code] - ends[:-1], length)]
        return [np.append(flat[a:b], np.uint32(END_ID)) for a, b in pairwise(ends[bounds])]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text with the end id."""
        out: list[np.ndarray | None] = [None] * len(texts)
        plain, other = [], []
        for i, text in enumerate(texts):
            if not text:
                out[i] = np.array([END_ID], np.uint32)
            else:
                (plain if "<|" not in text and PLAIN.fullmatch(text) else other).append(i)
        size = np.cumsum([len(texts[i]) for i in plain]) // RUN_CHARS
        for _, run in groupby(range(len(plain)), size.__getitem__):
            where = [plain[j] for j in run]
            for i, ids in zip(where, self._encode_plain([texts[i] for i in where])):
                out[i] = ids
        if other:
            for i, ids in zip(other, self._encode_whole([texts[i] for i in other])):
                out[i] = np.array([*ids, END_ID], np.uint32)
        return out


def worker_encoder(path: str) -> Encoder:
    """The Python worker's encoder, kept for its later tokenizing tasks."""
    kept = kept_objects()
    if path not in kept:
        kept[path] = Encoder(path)
    return kept[path]


def _tokenize(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = worker_encoder(path)
        for b in batches:
            ids = enc.encode(column(b, "text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    column(b, "doc_id"),
                    column(b, "tie"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.astype("<u2" if x.max() < 65536 else "<u4").tobytes() for x in ids], pa.binary()),
                ],
                ["doc_id", "tie", "n_tokens", "ids"],
            )

    return run


def _raw(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, "<u2" if len(blob) == 2 * n else "<u4").astype(np.uint32)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0, np.int64)
    for b in batches:
        parts = [_raw(x, n) for x, n in zip(column(b, "ids").to_pylist(), column(b, "n_tokens").to_pylist())]
        got = np.bincount(np.concatenate(parts)) if parts else total[:0]
        if len(got) < len(total):
            got = np.pad(got, (0, len(total) - len(got)))
        got[: len(total)] += total
        total = got
    seen = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])


def tokenized(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Scratch table (doc_id, tie, n_tokens, ids) of all rows of ``docs``."""
    tune(docs.sparkSession)
    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("bigint"), F.xxhash64("text").alias("tie"), "text")
    return saved(rows.mapInArrow(frugal(_tokenize(path or tokenizer_path()), keeps=True), "doc_id bigint, tie bigint, n_tokens bigint, ids binary"), "token-ids")


def id_ranks(ids: DataFrame) -> np.ndarray:
    """Ids in descending corpus frequency, then ascending id. One entry per id
    in use: at most the tokenizer's vocabulary."""
    counts = ids.select("n_tokens", "ids").mapInArrow(frugal(_count), "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    rows = sorted((-r["n"], r["id"]) for r in counts.collect())
    return np.array([i for _, i in rows], np.uint32)


# ---- files ---------------------------------------------------------------


def _write(root: str, by_rank: np.ndarray):
    rank = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        name, out, docs, values, crc = f"part-{part:06d}.tok", None, 0, 0, 0
        for b in batches:
            for doc, n, ids in zip(*(column(b, c).to_pylist() for c in ("doc_id", "n_tokens", "ids"))):
                out = out or CommittedFile(root, name)
                control, data = vbyte_encode(rank[_raw(ids, n)])
                rec = struct.pack(HEAD, doc or 0, doc is None, n, len(data)) + control + data
                out.write(rec)
                crc = zlib.crc32(rec, crc)
                docs, values = docs + 1, values + n
        if out:
            out.commit()
            yield pa.RecordBatch.from_pylist([{"part": part, "file": name, "docs": docs, "n_values": values, "bytes": out.size, "crc": crc}], schema=_MANIFEST)

    return run


_MANIFEST = pa.schema([("part", pa.int64()), ("file", pa.string()), ("docs", pa.int64()), ("n_values", pa.int64()), ("bytes", pa.int64()), ("crc", pa.int64())])


def write_token_files(docs: DataFrame, root: str, path: str | None = None, tokens_per_file: int = TOKENS_PER_FILE) -> DataFrame:
    """Write ``docs`` as token files below ``root`` in ascending doc_id order;
    returns the manifest (one row per file)."""
    spark = docs.sparkSession
    ids = tokenized(docs, path)
    by_rank = id_ranks(ids)
    total = ids.agg(F.sum("n_tokens").alias("n")).first()["n"] or 0
    files = max(1, -(-total // tokens_per_file))
    spark.createDataFrame(
        [(r, int(i)) for r, i in enumerate(by_rank)], "rank bigint, id bigint"
    ).coalesce(1).write.mode("overwrite").parquet(f"{root}/ranks.parquet")
    ordered = ids.repartitionByRange(files, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    rows = ordered.select("doc_id", "n_tokens", "ids").mapInArrow(
        frugal(_write(root, by_rank)), "part bigint, file string, docs bigint, n_values bigint, bytes bigint, crc bigint"
    )
    rows.write.mode("overwrite").parquet(f"{root}/manifest")
    drop_temporary(root)
    return spark.read.parquet(f"{root}/manifest")


def _read(root: str, by_rank: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, start, want in zip(*(column(b, c).to_pylist() for c in ("file", "start", "crc"))):
                crc, rows = 0, []
                with open_stream(root, name) as f:
                    while head := f.read(HEAD_BYTES):
                        doc, null, n, size = struct.unpack(HEAD, head)
                        control, data = f.read(-(-n // 4)), f.read(size)
                        crc = zlib.crc32(data, zlib.crc32(control, zlib.crc32(head, crc)))
                        rows.append((None if null else doc, start, n, by_rank[vbyte_decode(control, data, n)].astype("<u4").tobytes()))
                        start += n
                        if len(rows) == 256:
                            yield _ids_batch(rows)
                            rows = []
                if crc != want:
                    raise OSError(f"{name}: crc32 {crc}, the manifest has {want}")
                if rows:
                    yield _ids_batch(rows)

    return run


def _ids_batch(rows: list[tuple]) -> pa.RecordBatch:
    doc, start, n, ids = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
        ["doc_id", "start", "n_tokens", "ids"],
    )


def read_token_files(spark: SparkSession, root: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids as little-endian uint32) of every document,
    decoded from the files the manifest names; one task reads whole files."""
    tune(spark)
    manifest = spark.read.parquet(f"{root}/manifest")
    ranks = spark.read.parquet(f"{root}/ranks.parquet").orderBy("rank").collect()  # at most the vocabulary
    by_rank = np.array([r["id"] for r in ranks], np.uint32)
    before = F.sum("n_values").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.select("file", "crc", F.coalesce(before, F.lit(0)).alias("start"))  # a row per file
    return files.repartition(max(1, manifest.count())).mapInArrow(
        frugal(_read(root, by_rank)), "doc_id bigint, start bigint, n_tokens bigint, ids binary"
    )


def token_output(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the files to the shared folder and return from them, per document,
    doc_id, start, n_tokens and the crc32 of its ids."""
    root = scratch_path(docs.sparkSession, "token-files")
    write_token_files(docs, root, path)
    return read_token_files(docs.sparkSession, root).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output(table(spark, sf_dir, "documents"))
