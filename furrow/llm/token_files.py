"""Token ids in fixed-width binary files.

Every id takes the bits that the vocabulary needs, no more. A file holds blocks of
``BLOCK`` ids, each packed by itself, then an index, then a tail of fixed size:

    magic | blocks | offsets of blocks, CRC-32 of blocks, document ids, null flags, starts | tail

As the width is fixed, any stretch of ids is found from the offset of its block and one
multiplication, and is unpacked by numpy without looking at what lies before it.

The files are a Spark data source, ``packed_ids``. Writing: each task writes one file
under a name of its own; the names enter the manifest only when the job commits, so a
task that is lost and run again, or runs twice, leaves nothing that counts. Reading: a
file is cut into ranges of documents, and a task reads the blocks of its range.

Documents are range-shuffled by id, so the order of the files is the order of the ids.
Texts are encoded after that shuffle, a batch at a time: its distinct words are found by
Arrow, words that this worker has not met yet go to the tokenizer, and the batch's ids
are gathered from both. That is exact where no token crosses white space, or the place
between a letter or digit and ASCII punctuation; ``word_bounded`` says whether a
tokenizer is of that kind, and for any other whole texts are encoded.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from furrow.llm.common import narrow

FORMAT = "packed_ids"
MAGIC = b"FURROWT1"
TAIL = struct.Struct("<QQQQII8s")
MANIFEST = "manifest.json"
#: Ids of a block; a multiple of 8, so that whole blocks fill whole bytes.
BLOCK = 1 << 15
#: Ids a reading task takes at most, except for one longer document.
RANGE_IDS = 1 << 24
#: Distinct words a worker remembers with their ids before it starts anew. Speed only.
MEMO_WORDS = 400_000
#: Bytes of text that are encoded at once, except for one longer text. Memory only.
SLICE_BYTES = 1 << 21


# ---- bits ---------------------------------------------------------------------------


def bits_for(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Little-endian, ``bits`` an id; filled with zeros to a multiple of 8 ids."""
    rows = np.zeros(-(-len(ids) // 8) * 8, dtype=np.uint64)
    rows[: len(ids)] = ids
    if len(ids) and int(rows.max()) >> bits:
        raise ValueError(f"an id does not fit into {bits} bits")
    rows = rows.reshape(-1, 8)
    out = np.zeros((len(rows), bits), dtype=np.uint8)
    for j in range(8):
        low, shift = divmod(j * bits, 8)
        moved = rows[:, j] << np.uint64(shift)
        for b in range(low, -(-(j + 1) * bits // 8)):
            out[:, b] |= (moved >> np.uint64(8 * (b - low))).astype(np.uint8)
    return out.tobytes()


def unpack(data: bytes, bits: int, first: int, last: int) -> np.ndarray:
    """The ids at ``first`` to ``last`` (exclusive) of packed ``data``; only the bytes that
    hold them are touched."""
    low = first // 8
    rows = np.frombuffer(data, dtype=np.uint8, offset=low * bits, count=(-(-last // 8) - low) * bits).reshape(-1, bits)
    out = np.empty((len(rows), 8), dtype=np.uint32)
    for j in range(8):
        at, shift = divmod(j * bits, 8)
        value = np.zeros(len(rows), dtype=np.uint64)
        for b in range(at, -(-(j + 1) * bits // 8)):
            value |= rows[:, b].astype(np.uint64) << np.uint64(8 * (b - at))
        out[:, j] = (value >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return out.reshape(-1)[first - low * 8 : last - low * 8]


# ---- files --------------------------------------------------------------------------


def file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The store of ``path`` and the path in it: a local or mounted folder, or any store
    that Arrow opens by its URI."""
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class PackedWriter:
    """One file, written front to back; only its index is held."""

    def __init__(self, out, bits: int, block: int = BLOCK):
        self.out, self.bits, self.block = out, bits, block
        self.offsets, self.checks = [len(MAGIC)], []
        self.doc_ids, self.starts = [], [np.zeros(1, dtype=np.uint64)]
        self.n_ids, self.n_docs = 0, 0
        self.rest = np.empty(0, dtype=np.uint32)
        out.write(MAGIC)

    def add(self, doc_ids: list[int | None], ends: np.ndarray, ids: np.ndarray) -> None:
        """Documents whose ids lie behind each other in ``ids``, the i-th one up to ``ends[i]``."""
        self.doc_ids += doc_ids
        self.starts.append(ends.astype(np.uint64) + np.uint64(self.n_ids))
        self.n_ids += len(ids)
        self.n_docs += len(doc_ids)
        held = np.concatenate([self.rest, ids.astype(np.uint32)])
        whole = len(held) // self.block * self.block
        for at in range(0, whole, self.block):
            self._block(held[at : at + self.block])
        self.rest = held[whole:]

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.out.write(data)
        self.offsets.append(self.offsets[-1] + len(data))
        self.checks.append(zlib.crc32(data))

    def close(self) -> None:
        if len(self.rest):
            self._block(self.rest)
        null = np.array([d is None for d in self.doc_ids], dtype=bool)
        known = np.array([0 if d is None else d for d in self.doc_ids], dtype="<i8")
        self.out.write(np.array(self.offsets, dtype="<u8").tobytes())
        self.out.write(np.array(self.checks, dtype="<u4").tobytes())
        self.out.write(known.tobytes())
        self.out.write(np.packbits(null, bitorder="little").tobytes())
        self.out.write(np.concatenate(self.starts).astype("<u8").tobytes())
        self.out.write(TAIL.pack(self.offsets[-1], self.n_ids, self.n_docs, len(self.checks), self.bits, self.block, MAGIC))
        self.out.close()


class PackedFile:
    """A written file, opened for random access: its index is read, blocks when asked for."""

    def __init__(self, store: fs.FileSystem, path: str):
        self.file = store.open_input_file(path)
        size = self.file.size()
        index, self.n_ids, self.n_docs, n_blocks, self.bits, self.block, magic = TAIL.unpack(self.file.read_at(TAIL.size, size - TAIL.size))
        if magic != MAGIC or bytes(self.file.read_at(len(MAGIC), 0)) != MAGIC:
            raise ValueError(f"{path} is not a file of packed ids")
        data, at = self.file.read_at(size - TAIL.size - index, index), 0

        def part(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(data, dtype=kind, count=n, offset=at)
            at += out.nbytes
            return out

        self.offsets, self.checks = part("<u8", n_blocks + 1), part("<u4", n_blocks)
        self.doc_ids, flags = part("<i8", self.n_docs), part("u1", -(-self.n_docs // 8))
        self.no_id = np.unpackbits(flags, count=self.n_docs, bitorder="little").astype(bool)
        self.starts = part("<u8", self.n_docs + 1).astype(np.int64)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids at ``first`` to ``last`` (exclusive) of the file."""
        if not 0 <= first <= last <= self.n_ids:
            raise IndexError(f"{first} to {last} of {self.n_ids} ids")
        if first == last:
            return np.empty(0, dtype=np.uint32)
        a, b = first // self.block, (last - 1) // self.block + 1
        begin, end = int(self.offsets[a]), int(self.offsets[b])
        data = bytes(self.file.read_at(end - begin, begin))
        for k in range(a, b):
            if zlib.crc32(data[int(self.offsets[k]) - begin : int(self.offsets[k + 1]) - begin]) != int(self.checks[k]):
                raise ValueError(f"block {k} is damaged")
        return unpack(data, self.bits, first - a * self.block, last - a * self.block)

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.starts[i]), int(self.starts[i + 1]))

    def close(self) -> None:
        self.file.close()


# ---- data source --------------------------------------------------------------------


@dataclass
class Written(WriterCommitMessage):
    partition: int
    name: str
    n_docs: int
    n_ids: int


class PackedSink(DataSourceArrowWriter):
    """Options: ``path`` and ``vocabulary``. Rows: a document's id and its token ids."""

    def __init__(self, path: str, vocabulary: int):
        self.path, self.bits, self.vocabulary = path, bits_for(vocabulary), vocabulary

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        partition = TaskContext.get().partitionId()
        store, path = file_system(self.path)
        name, out = f"part-{partition:06d}-{uuid.uuid4().hex}.ids", None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                store.create_dir(path, recursive=True)
                out = PackedWriter(store.open_output_stream(f"{path}/{name}"), self.bits)
            lists = batch.column(1)
            ends = np.asarray(lists.offsets)[1:] - lists.offsets[0].as_py()
            out.add(batch.column(0).to_pylist(), ends, lists.flatten().to_numpy(zero_copy_only=False))
        if out is None:
            return Written(partition, "", 0, 0)
        out.close()
        return Written(partition, name, out.n_docs, out.n_ids)

    def commit(self, messages: list[Written | None]) -> None:
        store, path = file_system(self.path)
        files, start = [], 0
        for m in sorted((m for m in messages if m is not None and m.n_docs), key=lambda m: m.partition):
            files.append({"name": m.name, "n_docs": m.n_docs, "n_ids": m.n_ids, "start": start})
            start += m.n_ids
        store.create_dir(path, recursive=True)
        with store.open_output_stream(f"{path}/{MANIFEST}") as out:
            out.write(json.dumps({"bits": self.bits, "vocabulary": self.vocabulary, "n_ids": start, "files": files}).encode())

    def abort(self, messages: list[Written | None]) -> None:
        store, path = file_system(self.path)
        for m in messages:
            if m is not None and m.name and store.get_file_info(f"{path}/{m.name}").type == fs.FileType.File:
                store.delete_file(f"{path}/{m.name}")


@dataclass
class Documents(InputPartition):
    """Documents ``first`` to ``last`` of a file; ``start``: ids of all files before it."""

    name: str
    first: int
    last: int
    start: int


def manifest(path: str) -> dict:
    store, there = file_system(path)
    with store.open_input_stream(f"{there}/{MANIFEST}") as held:
        return json.loads(held.read())


class PackedReader(DataSourceReader):
    def __init__(self, path: str, range_ids: int):
        self.path, self.range_ids = path, range_ids

    def partitions(self) -> list[InputPartition]:
        out: list[InputPartition] = []
        for f in manifest(self.path)["files"]:
            # As many ranges of documents as the file's ids ask for; the exact cut needs no index here.
            parts = min(f["n_docs"], -(-f["n_ids"] // self.range_ids))
            cuts = [f["n_docs"] * i // parts for i in range(parts + 1)]
            out += [Documents(f["name"], a, b, f["start"]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out or [Documents("", 0, 0, 0)]

    def read(self, partition: Documents) -> Iterator[pa.RecordBatch]:
        if not partition.name:
            return
        store, path = file_system(self.path)
        held = PackedFile(store, f"{path}/{partition.name}")
        first = partition.first
        while first < partition.last:
            # Batches of about a million ids, one document at least.
            stop = int(np.searchsorted(held.starts, held.starts[first] + (1 << 20), side="right")) - 1
            last = min(max(stop, first + 1), partition.last)
            begin, starts = int(held.starts[first]), held.starts[first : last + 1]
            ids = held.ids(begin, int(starts[-1])).view(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(held.doc_ids[first:last], pa.int64(), mask=held.no_id[first:last]),
                    pa.array(starts[:-1] + partition.start, pa.int64()),
                    pa.array(np.diff(starts), pa.int64()),
                    pa.ListArray.from_arrays(pa.array((starts - begin).astype(np.int32)), pa.array(ids)),
                ],
                names=["doc_id", "start", "n_tokens", "ids"],
            )
            first = last
        held.close()


class PackedIds(DataSource):
    """``spark.read.format("packed_ids")`` gives ``doc_id``, ``start`` (ids before it in the
    whole table), ``n_tokens`` and ``ids``; writing takes an id and an array of ids."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "doc_id long, start long, n_tokens long, ids array<int>"

    def reader(self, schema: StructType) -> DataSourceReader:
        return PackedReader(self.options["path"], int(self.options.get("rangeIds", RANGE_IDS)))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return PackedSink(self.options["path"], int(self.options["vocabulary"]))


# ---- encoding -----------------------------------------------------------------------

#: Where a space may be put in without a change of the tokens: behind a letter or digit,
#: before ASCII punctuation. Not in texts that may name a special token.
CUT, CUT_TO = r"([\p{L}\p{N}])([!-/:-@\[-`{-~])", r"\1 \2"
SPECIAL = "<|"


def word_bounded(config: dict) -> bool:
    """Whether words may be encoded one by one: white space is dropped, letter case is
    folded, and a pattern that keeps letters apart from punctuation splits the text."""
    normalizers = [n["type"] for n in (config.get("normalizer") or {}).get("normalizers", [])]
    splits = [p for p in (config.get("pre_tokenizer") or {}).get("pretokenizers", []) if p["type"] == "Split"]
    plain = not any(t["lstrip"] or t["rstrip"] or SPECIAL not in t["content"] for t in config.get("added_tokens", []))
    return (
        plain
        and normalizers == ["NFC", "Replace", "Lowercase"]
        and len(splits) == 1
        and splits[0]["behavior"] == "Removed"
        and splits[0]["invert"]
        and splits[0]["pattern"]["Regex"].endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
    )


class Encoder:
    """A tokenizer and the words it has been asked for."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as held:
            config = json.load(held)
        self.by_word = word_bounded(config)
        # Which ids end a word, for words that are encoded many at once.
        suffix = config["model"].get("end_of_word_suffix")
        self.ends_word = np.zeros(self.tokenizer.get_vocab_size(with_added_tokens=True), dtype=bool)
        if suffix:
            self.ends_word[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.words = pa.array([], pa.string())
        self.flat = np.empty(1 << 16, dtype=np.int32)
        self.ends = np.zeros(1 << 14, dtype=np.int64)

    def whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of texts, each encoded in one piece."""
        found = [np.array(e.ids, dtype=np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([len(f) for f in found], dtype=np.int64), np.concatenate([np.empty(0, dtype=np.int32), *found])

    def learn(self, words: list[str]) -> None:
        """Adds words that are not known yet."""
        letters = [w for w in words if w.isalpha()]
        others = [w for w in words if not w.isalpha()]
        known = len(self.words)
        for group, of_letters in ((letters, True), (others, False)):
            for at in range(0, len(group), 1_000):
                some = group[at : at + 1_000]
                lengths, ids = self.ids_of(some, of_letters)
                end = int(self.ends[known])
                if end + len(ids) > len(self.flat):
                    self.flat = np.concatenate([self.flat, np.empty(len(self.flat) + len(ids), dtype=np.int32)])
                if known + len(some) >= len(self.ends):
                    self.ends = np.concatenate([self.ends, np.zeros(len(self.ends) + len(some), dtype=np.int64)])
                self.flat[end : end + len(ids)] = ids
                self.ends[known + 1 : known + 1 + len(some)] = end + np.cumsum(lengths)
                known += len(some)
        self.words = pa.concat_arrays([self.words, pa.array(letters + others, pa.string())])

    def ids_of(self, words: list[str], of_letters: bool) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of words, each encoded by itself. Words of letters alone are one
        pre-token each, so they may share a text if the marks of word ends bear that out."""
        if of_letters:
            ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, dtype=np.int32)
            last = np.flatnonzero(self.ends_word[ids])
            if len(last) == len(words) and last[-1] == len(ids) - 1:
                return np.diff(last, prepend=-1), ids
        found = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        return np.bincount(np.array(found.word_ids, dtype=np.int64), minlength=len(words)), np.array(found.ids, dtype=np.int32)

    def by_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of texts, gathered from those of their words."""
        words = pc.ascii_split_whitespace(pc.replace_substring_regex(pc.ascii_lower(texts), CUT, CUT_TO))
        coded = words.flatten().dictionary_encode()
        if len(self.words) > MEMO_WORDS:
            self.forget()
        # Text of nothing but white space gives an empty word.
        unknown = pc.invert(pc.is_in(coded.dictionary, value_set=self.words))
        self.learn(coded.dictionary.filter(unknown).to_pylist())
        at = pc.index_in(coded.dictionary, value_set=self.words).to_numpy(zero_copy_only=False)[coded.indices.to_numpy()]
        known = len(self.words)
        lists = pa.ListArray.from_arrays(pa.array(self.ends[: known + 1].astype(np.int32)), pa.array(self.flat[: int(self.ends[known])]))
        found = lists.take(pa.array(at))
        ids = found.flatten().to_numpy(zero_copy_only=False)
        borders = np.asarray(found.offsets)[np.asarray(words.offsets) - words.offsets[0].as_py()].astype(np.int64)
        return np.diff(borders), ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids, one behind the other, of texts without nulls."""
        if not self.by_word:
            return self.whole(texts.to_pylist())
        special = pc.match_substring(texts, SPECIAL)
        odd = np.flatnonzero(special.to_numpy(zero_copy_only=False))
        lengths, ids = self.by_words(pc.if_else(special, "", texts))
        if not len(odd):
            return lengths, ids
        own, own_ids = self.whole(texts.take(pa.array(odd)).to_pylist())
        places = np.repeat(np.cumsum(lengths)[odd], own)
        lengths[odd] = own
        return lengths, np.insert(ids, places, own_ids)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker; it outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches cut into stretches of rows whose texts have ``SLICE_BYTES`` or are one."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
        before, first = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), 0
        while first < batch.num_rows:
            last = max(int(np.searchsorted(before, before[first] + SLICE_BYTES, side="right")) - 1, first + 1)
            yield batch.slice(first, last - first)
            first = last
        # Arrow keeps what it freed for itself; other workers of the executor need it too.
        pa.default_memory_pool().release_unused()


def encoded(
    docs: DataFrame, tokenizer: str, end_id: int | None, files: int | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id`` and ``ids`` of every whole text, ``end_id`` behind them, documents in the
    order of the id over all partitions: null first, equal ids by a hash of the text and
    then as they come. Null and empty texts have the end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        for batch in slices(batches):
            texts = batch.column("text")
            lengths, ids = own.encode(texts if isinstance(texts, pa.StringArray) else texts.cast(pa.string()))
            if end_id is not None:
                ids = np.insert(ids, np.cumsum(lengths), end_id)
                lengths = lengths + 1
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))], names=["doc_id", "ids"]
            )

    base = narrow(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.xxhash64("text").alias("hash"),
        F.monotonically_increasing_id().alias("place"),
    )
    # Rows that share an id, or have none, are cut into slices by the other two.
    order = ["doc_id", "hash", "place"]
    cut = base.repartitionByRange(files, *order) if files else base.repartitionByRange(*order)
    ordered = cut.sortWithinPartitions(*order).select("doc_id", "text")
    return ordered.mapInArrow(run, "doc_id long, ids array<int>")


def write(ids: DataFrame, path: str, vocabulary: int) -> None:
    """Writes rows (id, array of ids) as they are ordered and dealt. ``path`` must be new."""
    ids.sparkSession.dataSource.register(PackedIds)
    ids.write.format(FORMAT).mode("append").option("vocabulary", vocabulary).save(path)


def read(spark: SparkSession, path: str, range_ids: int = RANGE_IDS) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids`` of written files."""
    spark.dataSource.register(PackedIds)
    return spark.read.format(FORMAT).option("rangeIds", range_ids).load(path)


def write_documents(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int | None = None,
    files: int | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encodes every whole text and writes the ids in ascending order of the document id, to
    about so many ``files``, or as many as the session's shuffle settings give.

    Null ids come first; rows that share an id are all written, in the order of a hash of
    their text. A null text counts as empty: it has the end id alone, or nothing. Very
    long texts are encoded whole. An empty table gives a manifest without files. Ids must
    be integers. Other columns are left behind, whatever they are called."""
    write(encoded(docs, tokenizer, end_id, files, id_col, text_col), path, vocabulary_size(tokenizer))


def stretches(wanted: DataFrame, path: str) -> DataFrame:
    """Random access: the ids at ``start`` to ``start + length`` of the whole table for each
    row of ``wanted`` (start, length), cut at the table's ends; null where either is null.

    Each task reads only the blocks that its rows ask for. The list of files, one entry a
    written part, is sent along."""
    files = manifest(path)["files"]
    firsts = np.array([f["start"] for f in files] or [0], dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, there = file_system(path)
        held: dict[int, PackedFile] = {}

        def cut(start: int | None, length: int | None) -> list[int] | None:
            if start is None or length is None:
                return None
            begin, end, out = max(start, 0), max(start, 0) + max(length, 0), []
            k = max(int(np.searchsorted(firsts, begin, side="right")) - 1, 0)
            while k < len(files) and files[k]["start"] < end:
                if k not in held:
                    if len(held) > 16:
                        held.pop(next(iter(held))).close()
                    held[k] = PackedFile(store, f"{there}/{files[k]['name']}")
                a, b = begin - files[k]["start"], end - files[k]["start"]
                out += held[k].ids(min(max(a, 0), held[k].n_ids), min(b, held[k].n_ids)).tolist()
                k += 1
            return out

        for batch in batches:
            starts, lengths = (batch.column(c).to_pylist() for c in ("start", "length"))
            got = [cut(s, n) for s, n in zip(starts, lengths, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("start"), batch.column("length"), pa.array(got, pa.list_(pa.int32()))], names=["start", "length", "ids"]
            )

    base = narrow(wanted, start="start", length="length").select(F.col("start").cast("long"), F.col("length").cast("long"))
    return base.sortWithinPartitions("start").mapInArrow(run, "start long, length long, ids array<int>")


def checksums(read_back: DataFrame) -> DataFrame:
    """Of rows of ``read``: the CRC-32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4")
            at = np.asarray(lists.offsets) - lists.offsets[0].as_py()
            crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return read_back.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
