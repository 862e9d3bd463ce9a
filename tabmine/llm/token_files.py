"""Token-id shards: independent zstandard frames, a document index and a trailing seek table.

File layout (all integers little-endian):

    frame 0 .. frame F-1   independent zstd frames, each the ids of one or more whole documents
    index                  skippable zstd frame (magic 0x184D2A50) holding a zstd frame of the document index
    seek table             skippable zstd frame (magic 0x184D2A5E) in the public seekable layout

The seek table has one entry per frame: compressed size, raw size and the low 32 bits of the XXH64 of the raw bytes,
then the number of frames, a descriptor byte (0x80: checksums) and the magic 0x8F92EAB1. The index has, per document,
doc_id, a null flag, number of ids, frame number and byte offset in the raw frame; it starts with the id width in bytes.
A reader loads the two tail frames, then decompresses only the frames of the documents it wants, and checks each frame's
checksum. Any zstd tool still decompresses the whole file.
"""

from __future__ import annotations

import string
import struct
import zlib
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_dir, tidy, utf8

INDEX_MAGIC, SEEK_MAGIC, FOOTER_MAGIC = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1
INDEX_DTYPE = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u4"), ("frame", "<u4"), ("at", "<u4")])
#: Raw bytes after which a frame is closed; a longer document is a frame of its own.
FRAME_BYTES = 1 << 18


class ShardWriter:
    """Writes one shard file to any file system that pyarrow.fs knows, by a temporary name first."""

    def __init__(self, uri: str, name: str, width: int):
        self.fs, root = pafs.FileSystem.from_uri(uri)
        self.fs.create_dir(root, recursive=True)
        self.path, self.tmp = f"{root}/{name}", f"{root}/_{name}.{np.random.default_rng().integers(1 << 62):x}"
        self.out = self.fs.open_output_stream(self.tmp)
        self.dtype = np.dtype("<u2" if width == 2 else "<u4")
        self.z = zstandard.ZstdCompressor(level=1)
        self.entries: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int, int, int]] = []
        self.buf, self.size = [], 0

    def add(self, doc_id: int | None, raw: bytes) -> None:
        """One document: its ids as little-endian bytes of the file's width."""
        if self.size and self.size + len(raw) > FRAME_BYTES:
            self._close_frame()
        self.index.append((doc_id or 0, doc_id is None, len(raw) // self.dtype.itemsize, len(self.entries), self.size))
        self.buf.append(raw)
        self.size += len(raw)

    def _close_frame(self) -> None:
        raw = b"".join(self.buf)
        z = self.z.compress(raw)
        self.out.write(z)
        self.entries.append((len(z), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.buf, self.size = [], 0

    def close(self) -> None:
        if self.buf:
            self._close_frame()
        index = bytes([self.dtype.itemsize]) + np.array(self.index, INDEX_DTYPE).tobytes()
        z = self.z.compress(index)
        self.out.write(struct.pack("<II", INDEX_MAGIC, len(z)) + z)
        seek = b"".join(struct.pack("<III", *e) for e in self.entries) + struct.pack("<IBI", len(self.entries), 0x80, FOOTER_MAGIC)
        self.out.write(struct.pack("<II", SEEK_MAGIC, len(seek)) + seek)
        self.out.close()
        self.fs.move(self.tmp, self.path)


class ShardReader:
    """Random access to one shard file."""

    def __init__(self, uri: str, name: str):
        fs, root = pafs.FileSystem.from_uri(uri)
        self.file = fs.open_input_file(f"{root}/{name}")
        size = self.file.size()
        frames, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or flags != 0x80:
            raise ValueError(f"{name}: no seek table")
        seek_at = size - 9 - 12 * frames
        table = np.frombuffer(self._at(seek_at, 12 * frames), "<u4").reshape(-1, 3).astype(np.int64)
        self.sizes, self.raw_sizes, self.sums = table.T if frames else np.zeros((3, 0), np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        at = int(self.starts[-1])
        magic, n = struct.unpack("<II", self._at(at, 8))
        if magic != INDEX_MAGIC:
            raise ValueError(f"{name}: no document index")
        raw = zstandard.ZstdDecompressor().decompress(self._at(at + 8, n))
        self.dtype = np.dtype("<u2" if raw[0] == 2 else "<u4")
        self.index = np.frombuffer(raw[1:], INDEX_DTYPE)
        self._kept: tuple[int, bytes] | None = None

    def _at(self, pos: int, n: int) -> bytes:
        self.file.seek(pos)
        return self.file.read(n)

    def frame(self, k: int) -> bytes:
        if self._kept is None or self._kept[0] != k:
            raw = zstandard.ZstdDecompressor().decompress(self._at(int(self.starts[k]), int(self.sizes[k])), max_output_size=int(self.raw_sizes[k]))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[k]:
                raise ValueError(f"frame {k}: checksum")
            self._kept = (k, raw)
        return self._kept[1]

    def ids(self, row: int) -> np.ndarray:
        e = self.index[row]
        raw = self.frame(int(e["frame"]))
        return np.frombuffer(raw, self.dtype, int(e["n"]), int(e["at"])).astype("<u4")


class Encoder:
    """Byte-level BPE ids of whole texts with the tokenizers library, as little-endian bytes of `width` per id.

    A space between two characters that are no white space always starts a new pre-token, and so does the punctuation
    after the letters of a word's end. Texts are cut at those spaces and equal pieces are encoded once, without such a
    tail; `CACHE` bounds the pieces remembered, in two generations: what the younger one uses it takes over. A text that holds an added token of the vocabulary, such as
    <|endoftext|>, goes through the library whole, which finds the token as its plain call does."""

    CACHE = 500_000
    #: White space of any regular-expression dialect besides space and line feed: such texts are cut with more care.
    OTHER = [chr(c) for c in (9, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)]
    TAILS = string.punctuation
    JOINED = 256

    def __init__(self, path: str):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.width = 2 if self.tok.get_vocab_size() <= 1 << 16 else 4
        self.dtype, self.code = np.dtype(f"<u{self.width}"), "H" if self.width == 2 else "I"
        no_space = "[^" + "".join(map(re.escape, self.OTHER)) + r"\s]"
        self.cut = re.compile(f" (?={no_space})(?<={no_space} )").split
        self.black = re.compile(f"{no_space}*").fullmatch
        self.feed = self.tok.token_to_id("\u010a")  # the line feed in the byte alphabet
        vocabulary = self.tok.get_vocab(with_added_tokens=True)
        self.spaced = np.zeros(max(vocabulary.values(), default=0) + 1, bool)  # tokens that start with a space
        self.spaced[[k for t, k in vocabulary.items() if t[:1] == "\u0120"]] = True
        self.after: dict[str, bytes] = {}  # ids of a piece after a space, by the piece without that space
        self.before: dict[str, dict[str, bytes]] = {" ": {}, "": {}}  # both of the generation before
        self.plain: dict[str, bytes] = {}  # ids of a piece at a text's start, and of tails

    def pieces(self, text: str) -> list[str]:
        if "  " in text or " \n" in text or "\n " in text or text[:1] == " " or text[-1:] == " " or any(c in text for c in self.OTHER):
            return self.cut(text)
        return text.split(" ")

    def _ids(self, pieces: list[str], lead: str) -> list[bytes]:
        """Ids of each piece after `lead`. Pieces without white space go JOINED to a text and the ids are cut again:
        after a space, where a token starts with it (no other one of the piece does); else by line feeds between, as one
        between other characters is a token of its own."""
        out: dict[str, bytes] = {}
        odd = [p for p in pieces if not p or not self.black(p)] if "" in pieces or not self.black("".join(pieces)) else []
        if odd:
            out.update((p, array(self.code, e.ids).tobytes()) for p, e in zip(odd, self.tok.encode_batch_fast([lead + p for p in odd], add_special_tokens=False)))
        even = [p for p in pieces if p not in out] if odd else pieces
        groups = [even[i : i + self.JOINED] for i in range(0, len(even), self.JOINED)]
        if even:
            skip = 0 if lead else self.width
            texts = [" " + " ".join(g) for g in groups] if lead else ["\n" + "\n".join(g) for g in groups]
            ids = np.concatenate([np.array(e.ids, self.dtype) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)])
            at = (np.flatnonzero(self.spaced[ids] if lead else ids == self.feed) * self.width).tolist()
            raw = ids.tobytes()
            cut = [raw[a + skip : z] for a, z in zip(at, [*at[1:], len(raw)])]
            if not odd:
                return cut
            out.update(zip(even, cut))
        return [out[p] for p in pieces]

    def _missing(self, known: dict[str, bytes], pieces: set[str], lead: str) -> set[str]:
        """The pieces that are not in `known`, after taking over those of the generation before."""
        new = pieces.difference(known)
        was = self.before[lead]
        if new and was:
            fresh = new.difference(was)
            seen = list(new.difference(fresh))
            known.update(zip(seen, map(was.__getitem__, seen)))
            new = fresh
        return new

    def _look(self, known: dict[str, bytes], pieces: set[str], lead: str) -> dict[str, bytes]:
        """`known` with the ids of all pieces of a batch; new ones are learnt first."""
        new = self._missing(known, pieces, lead)
        if new:
            self._learn(known, new, lead)
        return known

    def _learn(self, known: dict[str, bytes], new: set[str], lead: str) -> None:
        """Adds the ids of new pieces to `known`. They are taken apart first: a single line feed between two
        characters that are no white space is a pre-token of its own, and so is a tail."""
        lines = {p: q for p in new if "\n" in p and (q := p.split("\n")) and all(x and self.black(x) for x in q)}
        inner = {x for q in lines.values() for x in q[1:]}
        self._tails(self.plain, self._missing(self.plain, inner, ""), "")
        self._tails(known, self._missing(known, {q[0] for q in lines.values()}.union(new.difference(lines)), lead), lead)
        if lines:
            if "\n" not in self.plain:
                self.plain["\n"] = self._ids(["\n"], "")[0]
            known.update((p, self.plain["\n"].join([known[q[0]], *(self.plain[x] for x in q[1:])])) for p, q in lines.items())

    def _tails(self, known: dict[str, bytes], new: set[str], lead: str) -> None:
        cut = {p: s for p in new if p[-1:] in self.TAILS and (s := p.rstrip(self.TAILS)) and s[-1].isalpha()}
        todo = list(self._missing(known, new.difference(cut).union(cut.values()), lead))
        known.update(zip(todo, self._ids(todo, lead)))
        tails = list({p[len(s) :] for p, s in cut.items()}.difference(self.plain))
        self.plain.update(zip(tails, self._ids(tails, "")))
        known.update((p, known[s] + self.plain[p[len(s) :]]) for p, s in cut.items())

    def encode(self, texts: list[str], end_id: int) -> list[bytes]:
        """The ids of each text, with the end id."""
        end = np.array([end_id], self.dtype).tobytes()
        whole = [k for k, t in enumerate(texts) if any(a in t for a in self.added)]
        if whole:
            out: list[bytes] = [b""] * len(texts)
            for k, e in zip(whole, self.tok.encode_batch_fast([texts[k] for k in whole], add_special_tokens=False)):
                out[k] = np.array(e.ids, self.dtype).tobytes() + end
            others = sorted(set(range(len(texts))).difference(whole))
            for k, ids in zip(others, self.encode([texts[k] for k in others], end_id) if others else []):
                out[k] = ids
            return out
        if len(self.after) + len(self.plain) > self.CACHE // 2:
            self.before = {" ": self.after, "": self.plain}
            self.after, self.plain = {}, {}
        per = [self.pieces(t) for t in texts]
        heads = [ps[0] for ps in per]
        first = self._look(self.plain, set(heads), "")
        rest = set()
        for ps in per:
            del ps[0]
            rest.update(ps)
        get = self._look(self.after, rest, " ").__getitem__
        return [first[h] + b"".join(map(get, ps)) + end for h, ps in zip(heads, per)]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, uri: str, vocabulary: str, end_id: int = 2, shards: int | None = None) -> DataFrame:
    """Write `docs` (doc_id, text) as shard files below `uri`, in ascending doc_id order over the shard names.

    Documents are range-partitioned by (doc_id, text hash), so a doc_id held by many rows still spreads; each partition
    streams its rows into one file. There are as many shards as input partitions (splits of bounded size) unless
    `shards` says otherwise. Returns one row per shard: shard (its name), n_docs, n_tokens; the frame is stored
    already. Null text: only the end id. Null doc_id: first, flagged in the index. Repeated rows are all written.
    An empty table writes no file. A retried task writes the same name again by an atomic move."""
    spark = docs.sparkSession
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = shards or max(1, src.rdd.getNumPartitions())
    src = src.withColumn("h", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h", "text")

    def write(batches):
        from pyspark import TaskContext

        enc, out, name, docs_n, tokens = _encoder(vocabulary), None, "", 0, 0
        for b in batches:
            ids = b.column(0).to_pylist()
            _, off = utf8(b.column(1))
            texts = b.column(1)
            i = 0
            while i < len(ids):
                j = max(i + 1, int(np.searchsorted(off, off[i] + (1 << 17), "right")) - 1)
                got = enc.encode([t or "" for t in texts.slice(i, j - i).to_pylist()], end_id)
                if out is None:
                    name = f"part-{TaskContext.get().partitionId():08d}.tok.zst"
                    out = ShardWriter(uri, name, enc.width)
                for d, raw in zip(ids[i:j], got):
                    out.add(d, raw)
                    tokens += len(raw) // enc.width
                docs_n += j - i
                i = j
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"shard": [name], "n_docs": [docs_n], "n_tokens": [tokens]})

    done = src.select("doc_id", "text").mapInArrow(tidy(write), "shard string, n_docs long, n_tokens long")
    path = f"{uri.rstrip('/')}-manifest"
    done.write.parquet(path)
    return spark.read.schema("shard string, n_docs long, n_tokens long").parquet(path)


def read_token_files(manifest: DataFrame, uri: str) -> DataFrame:
    """Every document of the shards, from the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.
    One row per shard goes to the driver to add up the shards' first ids."""
    spark = manifest.sparkSession
    rows, at, todo = manifest.orderBy("shard").collect(), 0, []
    for r in rows:
        todo.append((r["shard"], at))
        at += r["n_tokens"]
    work = spark.createDataFrame(todo, "shard string, base long").repartition(max(1, len(todo)), "shard")

    def read(batches):
        for b in batches:
            for shard, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                f = ShardReader(uri, shard)
                n = f.index["n"].astype(np.int64)
                crc = np.fromiter((zlib.crc32(f.ids(k).tobytes()) for k in range(len(n))), np.int64, len(n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(f.index["doc_id"], mask=f.index["null"].astype(bool)), pa.array(base + np.cumsum(n) - n), pa.array(n), pa.array(crc)],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return work.mapInArrow(tidy(read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_documents(uri: str, shard: str, doc_ids: set[int]) -> dict[int, np.ndarray]:
    """Ids of the wanted documents of one shard; only their frames are decompressed."""
    f = ShardReader(uri, shard)
    return {int(f.index["doc_id"][k]): f.ids(k) for k in np.flatnonzero(np.isin(f.index["doc_id"], list(doc_ids)) & (f.index["null"] == 0))}


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_output(docs: DataFrame, vocabulary: str | None = None, end_id: int = 2, uri: str | None = None) -> DataFrame:
    """Write the files (to a new folder of the shared one unless `uri` is given) and return what they hold."""
    uri = uri or scratch_dir(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, uri, vocabulary or vocabulary_path(), end_id), uri)
