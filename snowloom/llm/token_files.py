"""Token ids in Arrow's IPC file format: fixed-size-list batches of equal-length sequences with masks.

Documents are packed one after the other, each closed by an end id, into sequences of one length; only the
last sequence of a file is padded, and its mask says so. A sequence is a slice of the mapped file, found by
its number without reading anything else. Beside every token file lies one with the documents' places in it.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache
from itertools import chain
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from snowloom.session import materialize, scratch_folder

if TYPE_CHECKING:
    from tokenizers import Tokenizer

LENGTH = 2048
# Sequences per record batch.
ROWS = 64
END = 0
_HELD_CHUNKS = 500_000
_HELD_CHARS = 48
_TOGETHER = 32
_LONE_BLANK = re.compile(r"(?<=\S) (?=\S)")
# What Python calls white space, for Arrow's expressions.
_WHITE = r"[\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_BLANK_RUN = f" {_WHITE}|{_WHITE} "


def cuts_at_blanks(tokenizer: Tokenizer) -> bool:
    """Whether ids never reach across a single blank between two other characters.

    That holds for byte pairs behind the byte-level pre-tokenizer with its own pattern, where such a blank opens the
    next piece, if nothing rewrites the text before and no added token has a blank or takes one from its neighbours.
    """
    made = json.loads(tokenizer.to_str())
    pieces, added = made.get("pre_tokenizer") or {}, made.get("added_tokens") or []
    return (
        made["model"].get("type") == "BPE"
        and not made["model"].get("dropout")
        and not any(made.get(k) for k in ("normalizer", "truncation", "padding"))
        and pieces.get("type") == "ByteLevel"
        and pieces.get("use_regex", True)
        and not pieces.get("add_prefix_space")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"]) for t in added)
    )


class Encoder:
    """Ids of texts by a tokenizer of the tokenizers library, as integers of one type.

    Where ``cuts_at_blanks`` holds, texts are cut before those blanks by Arrow, the chunks of a batch are told apart
    by a dictionary, and only different ones are looked up or encoded; their ids are then put together by places.
    The ids of short chunks are remembered, in two generations of a bounded number of them: what is met again
    outlives the older one. Chunks not yet known are encoded together and told apart by the bytes that every
    id stands for. Any other tokenizer encodes whole texts.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = id_type(self.tokenizer.get_vocab_size())
        self.chunked = cuts_at_blanks(self.tokenizer)
        self.held: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.octets = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
        for token, i in self.tokenizer.get_vocab().items():
            self.octets[i] = len(token)

    def _learn(self, chunks: list[str]) -> list[bytes]:
        """The ids of every chunk."""
        plain = [c[:1] == " " and not c[1:2].isspace() and not c[-1].isspace() for c in chunks]
        part = [c for c, p in zip(chunks, plain) if p]
        known: list[bytes | None] = []
        if part:
            together = ["".join(part[i : i + _TOGETHER]) for i in range(0, len(part), _TOGETHER)]
            found = self.tokenizer.encode_batch_fast(together, add_special_tokens=False)
            ids = np.fromiter(chain.from_iterable(e.ids for e in found), self.kind)
            ends = np.cumsum([len(c.encode()) for c in part])
            reached = np.cumsum(self.octets[ids])
            at = np.minimum(np.searchsorted(reached, ends), len(ids) - 1)
            # A chunk has ids of its own if one ends where it begins and one where it ends.
            sure = reached[at] == ends
            sure[1:] &= sure[:-1].copy()
            raw, cuts = ids.tobytes(), np.concatenate([[0], (at + 1) * self.kind.itemsize]).tolist()
            known = [raw[a:b] if s else None for a, b, s in zip(cuts, cuts[1:], sure.tolist())]
        left = iter(known)
        out = [next(left) if p else None for p in plain]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([chunks[i] for i in rest], add_special_tokens=False)):
            out[i] = np.array(e.ids, self.kind).tobytes()
        return out

    def _looked_up(self, chunks: list[str]) -> list[bytes]:
        """The ids of every chunk behind a blank; chunks come without it."""
        if len(self.held) > _HELD_CHUNKS:
            self.held, self.older = {}, self.held
        held, older = self.held, self.older
        ids = list(map(held.get, chunks))
        new = []
        for i in [i for i, x in enumerate(ids) if x is None]:
            if (x := older.get(chunks[i])) is not None:
                held[chunks[i]] = ids[i] = x
            else:
                new.append(i)
        for i, x in zip(new, self._learn([" " + chunks[i] for i in new])):
            ids[i] = x
            if len(chunks[i]) <= _HELD_CHARS:
                held[chunks[i]] = x
        return ids

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each closed by the end id, and the number of ids of each."""
        size = self.kind.itemsize
        if not self.chunked:
            found = [[*e.ids, END] for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.array([i for ids in found for i in ids], self.kind), np.array([len(ids) for ids in found], np.int64)
        held = pa.array(texts, pa.string())
        odd = pc.match_substring_regex(held, _BLANK_RUN)
        plain = pc.split_pattern(held.filter(pc.invert(odd)), " ")
        cut = [_LONE_BLANK.split(t) for t in held.filter(odd).to_pylist()]
        odd = odd.to_numpy(zero_copy_only=False)
        chunks = pa.concat_arrays([plain.flatten(), pa.array([c for part in cut for c in part], pa.string())]).dictionary_encode()
        # Chunks per text, in the order of the chunks; then where each text's begin.
        order = np.argsort(odd, kind="stable")
        counts = np.concatenate([pc.list_value_length(plain).to_numpy(zero_copy_only=False), [len(part) for part in cut]]).astype(np.int64)
        firsts = np.cumsum(counts) - counts
        spelt = chunks.dictionary.to_numpy(zero_copy_only=False).tolist()
        place = chunks.indices.to_numpy().astype(np.int64)
        ids = self._looked_up(spelt)
        # A text's first chunk has no blank before it.
        opening = [spelt[i] for i in place[firsts].tolist()]
        first_of = {c: len(ids) + i for i, c in enumerate(dict.fromkeys(opening))}
        ids += self._learn(list(first_of))
        place[firsts] = [first_of[c] for c in opening]
        ids.append(np.array([END], self.kind).tobytes())
        # An end id after every text, and the texts in their own order.
        place = np.insert(place, firsts + counts, len(ids) - 1)
        counts += 1
        back = np.empty(len(texts), np.int64)
        back[order] = np.arange(len(texts))
        place = place[_spans((np.cumsum(counts) - counts)[back], counts[back])]
        counts = counts[back]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // size
        flat = np.frombuffer(b"".join(ids), self.kind)
        lengths = sizes[place]
        ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts)])]
        return flat[_spans((np.cumsum(sizes) - sizes)[place], lengths)], np.diff(ends)


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All numbers of all spans, one span after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


@cache
def encoder(path: str) -> Encoder:
    """One per Python worker, which keeps what it has learnt over its tasks."""
    return Encoder(path)


def id_type(vocabulary: int) -> np.dtype:
    return np.dtype("<u2") if vocabulary <= 1 << 16 else np.dtype("<u4")


def _filesystem(uri: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(uri)


def _schema(kind: np.dtype, length: int) -> pa.Schema:
    ids, mask = pa.list_(pa.from_numpy_dtype(kind), length), pa.list_(pa.bool_(), length)
    return pa.schema([pa.field("ids", ids, nullable=False), pa.field("mask", mask, nullable=False)])


_PLACES = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


class _Writer:
    """One pair of files, written under names of this attempt and renamed when complete."""

    def __init__(self, folder: str, name: str, attempt: str, kind: np.dtype, length: int):
        self.fs, self.folder = _filesystem(folder)
        self.fs.create_dir(self.folder, recursive=True)
        self.final = [f"{self.folder}/{name}.{part}.arrow" for part in ("tokens", "docs")]
        self.open = [f"{self.folder}/_{name}.{part}.{attempt}" for part in ("tokens", "docs")]
        self.kind, self.length, self.schema = kind, length, _schema(kind, length)
        self.sinks = [self.fs.open_output_stream(p) for p in self.open]
        self.tokens = pa.ipc.new_file(self.sinks[0], self.schema)
        self.docs = pa.ipc.new_file(self.sinks[1], _PLACES)
        self.rest: list[np.ndarray] = []
        self.waiting = self.total = 0

    def _batch(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        self.tokens.write_batch(
            pa.record_batch(
                [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)], schema=self.schema
            )
        )

    def add(self, doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        """The ids of some documents one after the other, and how many each has."""
        block = self.length * ROWS
        starts = self.total + np.cumsum(sizes) - sizes
        self.docs.write_batch(pa.record_batch([doc_ids.cast(pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], schema=_PLACES))
        self.rest.append(ids)
        self.waiting += len(ids)
        if self.waiting >= block:
            flat = np.concatenate(self.rest)
            whole = self.waiting // block * block
            for i in range(0, whole, block):
                self._batch(flat[i : i + block], block)
            self.rest, self.waiting = [flat[whole:].copy()], self.waiting - whole
        self.total += len(ids)

    def close(self) -> None:
        if self.waiting:
            flat = np.concatenate(self.rest)
            padded = np.zeros(-(-len(flat) // self.length) * self.length, self.kind)
            padded[: len(flat)] = flat
            self._batch(padded, len(flat))
        self.tokens.close()
        self.docs.close()
        for sink in self.sinks:
            sink.close()
        for made, final in zip(self.open, self.final):
            self.fs.move(made, final)


class TokenFile:
    """Random access to the sequences of one file; a local file is mapped, neither ids nor masks are copied."""

    def __init__(self, uri: str):
        fs, path = _filesystem(uri)
        self.source = pa.memory_map(path) if isinstance(fs, pa.fs.LocalFileSystem) else fs.open_input_file(path)
        self.file = pa.ipc.open_file(self.source)

    def __len__(self) -> int:
        n = self.file.num_record_batches
        return (n - 1) * ROWS + len(self.file.get_batch(n - 1)) if n else 0

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        """Ids and mask of sequence ``i``, both in the file's own memory. A mask has one bit an id, so it is an
        Arrow array, which can begin at any bit."""
        batch = self.file.get_batch(i // ROWS)
        ids, mask = (batch.column(c)[i % ROWS].values for c in ("ids", "mask"))
        return ids.to_numpy(zero_copy_only=True), mask

    def stream(self) -> Iterator[np.ndarray]:
        """All ids that the masks leave, batch by batch."""
        for i in range(self.file.num_record_batches):
            batch = self.file.get_batch(i)
            ids = batch.column("ids").flatten().to_numpy(zero_copy_only=True)
            mask = batch.column("mask").flatten()
            yield ids if mask.true_count == len(ids) else ids[mask.to_numpy(zero_copy_only=False)]


def write(docs: DataFrame, tokenizer: str, folder: str, length: int = LENGTH) -> DataFrame:
    """Encode ``docs`` into files of ``folder`` in ascending ``doc_id``; one row per file.

    Returns ``shard, tokens, docs, n_tokens, offset``: ``offset`` is the number of ids in all files before.
    Rows are range-partitioned and sorted, so every task writes one file from a stream of rows, and holds one
    record batch of ids. A task that is run again writes the same file under a new name and renames it.
    Null ids come first, rows of one id go by the hash of their text, a null text is an empty one.
    """
    spark = docs.sparkSession

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, encode, writer = TaskContext.get(), encoder(tokenizer), None
        for batch in batches:
            if not len(batch):
                continue
            if writer is None:
                name = f"part-{task.partitionId():06d}"
                writer = _Writer(folder, name, f"{task.taskAttemptId()}", encode.kind, length)
            writer.add(batch.column("doc_id"), *encode(batch.column("text").to_pylist()))
        if writer:
            writer.close()
            names = [f"{folder}/{p.rpartition('/')[2]}" for p in writer.final]
            yield pa.record_batch(
                [pa.array([task.partitionId()], pa.int32()), *(pa.array([n]) for n in names), pa.array([writer.total], pa.int64())],
                ["shard", "tokens", "docs", "n_tokens"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    shards = materialize(sorted_.mapInArrow(encoded, "shard int, tokens string, docs string, n_tokens long"), "token-shards")
    # One row per file.
    before = W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    return shards.withColumn("offset", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def read(shards: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, from the files alone."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            stream, held = TokenFile(row["tokens"]).stream(), np.zeros(0, "<u4")
            places = TokenFile(row["docs"]).file
            for k in range(places.num_record_batches):
                part, sums = places.get_batch(k), []
                for n in part.column("n_tokens").to_pylist():
                    pieces, have = [held], len(held)
                    while have < n:
                        pieces.append(next(stream).astype("<u4"))
                        have += len(pieces[-1])
                    flat = np.concatenate(pieces) if len(pieces) > 1 else held
                    sums.append(zlib.crc32(flat[:n].tobytes()))
                    held = flat[n:]
                starts = pa.array(part.column("start").to_numpy() + row["offset"], pa.int64())
                yield pa.record_batch(
                    [part.column("doc_id"), starts, part.column("n_tokens"), pa.array(sums, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    # One task per file: a row is a file's name, so rows weigh far more than their size says.
    files = max(1, shards.count())
    paths = shards.select("tokens", "docs", "offset").repartition(files)
    return paths.mapInArrow(documents, "doc_id long, start long, n_tokens long, ids_crc32 long")


def encode(docs: DataFrame, tokenizer: str, folder: str | None = None) -> DataFrame:
    """Write ``docs`` and read the files back: ``(doc_id, start, n_tokens, ids_crc32)``, one row per row.

    ``start`` counts the ids of all documents before; ``ids_crc32`` is over the ids with the end id as
    little-endian 32-bit integers. ``folder`` must be reached by all executors; without it a folder below
    ``spark.checkpoint.dir`` is taken. An empty table gives no files and no rows.
    """
    folder = folder or scratch_folder(docs.sparkSession, "token-files")
    return read(write(docs, tokenizer, folder))
