"""Token ids in files with frequency ranks and control bytes apart.

Ids are counted over the corpus and replaced by their rank, so that common
ones need one byte.  A block of documents holds a control stream, two bits for
each number saying how many bytes it has, and the stream of those bytes, low
byte first.  A numpy table gives the four lengths and their sum for each
control byte, so a block is decoded without a loop over its numbers.

Format of a block (numbers are little-endian): ``TKV1``; number of documents
and of ids (u32 each); ids of each document (u32); control bytes; data bytes.
Blocks are rows of Parquet files with their number of ids before in the same
part; the numbers of ids before each part and the ranks are Parquet files beside
them.  So the files lie in any store that Spark writes to.
"""

from __future__ import annotations

import codecs
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from evenground.llm.common import kept_in_worker, text_batches
from evenground.session import fresh_path, small_side, written

MAGIC = b"TKV1"
#: pattern of the pre-tokens of a byte-level vocabulary
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: the same for texts of ASCII alone
ASCII_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"""
BLOCK_IDS = 1 << 18
#: pre-tokens that a worker keeps, and the characters of the longest
CACHE = 750_000
LONGEST = 100
#: pre-tokens that go to the library at a time
LEARNED = 20_000
#: pre-tokens of texts taken as a whole that are looked up together
TOGETHER = 200_000
#: texts of about this many bytes are encoded together
CHUNK_BYTES = 8_000_000

# lengths of the four numbers of each control byte
SIZES = np.stack([(np.arange(256) >> shift & 3) + 1 for shift in (0, 2, 4, 6)], axis=1).astype(np.int64)


def pack(lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """One block from the documents' lengths and all their numbers."""
    numbers = np.concatenate((ids.astype(np.uint32), np.zeros(-len(ids) % 4, np.uint32)))
    size = 1 + (numbers > 0xFF).astype(np.int64) + (numbers > 0xFFFF) + (numbers > 0xFFFFFF)
    quads = (size - 1).reshape(-1, 4).astype(np.uint8)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    raw = numbers.astype("<u4").view(np.uint8).reshape(-1, 4)
    data = raw[np.arange(4) < size[:, None]]
    return MAGIC + struct.pack("<II", len(lengths), len(ids)) + lengths.astype("<u4").tobytes() + control.tobytes() + data.tobytes()


def unpack(block: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and numbers of a block."""
    if block[:4] != MAGIC:
        raise ValueError("no block of token ids")
    n_docs, n_ids = struct.unpack_from("<II", block, 4)
    lengths = np.frombuffer(block, "<u4", n_docs, 12)
    at, quads = 12 + 4 * n_docs, -(-n_ids // 4)
    size = SIZES[np.frombuffer(block, np.uint8, quads, at)].reshape(-1)
    data = np.concatenate((np.frombuffer(block, np.uint8, offset=at + quads), np.zeros(4, np.uint8)))
    starts = np.cumsum(size) - size
    out = np.zeros(len(size), np.uint32)
    for k in range(4):
        have = size > k
        out[have] |= data[starts[have] + k].astype(np.uint32) << np.uint32(8 * k)
    return lengths, out[:n_ids]


class Encoder:
    """Ids of whole texts with the tokenizers library.

    Texts are split into pre-tokens here, the library merges the new ones of a
    chunk in one call, and the ids of those seen before are kept.  Pre-tokens
    reach over a space only where white space follows white space, so each
    different stretch between spaces is looked at once a chunk, and the ids of the
    texts are gathered from those of the stretches.  A text with a stretch that
    ends in white space is split into pre-tokens as a whole.  A text that may hold
    a special token, and any other kind of tokenizer, goes to the library as it is.
    """

    def __init__(self, path: str) -> None:
        import json

        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        settings = json.loads(self.tokenizer.to_str())
        self.special = [t["content"] for t in settings.get("added_tokens", [])]
        pre = settings.get("pre_tokenizer") or {}
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.type = np.dtype(f"<u{self.width}")
        self.findall, self.find_ascii = regex.compile(PATTERN).findall, re.compile(ASCII_PATTERN, re.ASCII).findall
        # bytes as the characters of a byte-level vocabulary: printable ones as
        # they are, the others in order from 256 on
        plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
        others = [b for b in range(256) if b not in plain]
        self.signs = "".join(chr(b) if b in plain else chr(256 + others.index(b)) for b in range(256))
        # the library without its own split: pre-tokens stand between line breaks
        self.mark = self.signs[10]
        self.mark_id = self.tokenizer.token_to_id(self.mark)
        self.split = (
            settings.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex")
            and not pre.get("add_prefix_space") and self.mark_id is not None)
        self.merger = Tokenizer.from_file(path)
        self.merger.pre_tokenizer = pre_tokenizers.Split(self.mark, "isolated")
        # pre-tokens seen before, as Arrow strings, and their ids one behind the other
        self.known, self.flat, self.sizes = pa.array([], pa.string()), np.zeros(0, self.type), np.zeros(0, np.int64)

    def _name(self, words: str) -> str:
        return codecs.charmap_decode(words.encode(), "strict", self.signs)[0]

    def _learned(self, plain: list[str], lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens without and with a line break, and how many each
        has.  The library takes some thousand at a time, since its own record
        of a token is many times the size of an id."""
        flat, sizes = [np.zeros(0, self.type)], [np.zeros(0, np.int64)]
        for a in range(0, len(plain), LEARNED):
            joined = self._name("\n".join(plain[a : a + LEARNED]))
            ids = np.array(self.merger.encode_batch_fast([joined], add_special_tokens=False)[0].ids, self.type)
            marks = ids == self.mark_id
            flat.append(ids[~marks])
            sizes.append(np.diff(np.concatenate(([-1], np.flatnonzero(marks), [len(ids)]))) - 1)
        for w in lines:
            flat.append(np.array([t.id for t in self.tokenizer.model.tokenize(self._name(w))], self.type))
            sizes.append(np.array([len(flat[-1])]))
        return np.concatenate(flat), np.concatenate(sizes)

    def _looked_up(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different pre-tokens, and how many each has.  Short ones are
        kept; when there are too many, only those of this call stay."""
        at = pa.compute.index_in(words, value_set=self.known)
        unseen = np.flatnonzero(at.is_null().to_numpy(zero_copy_only=False))
        number = at.fill_null(0).to_numpy().astype(np.int64)
        new = words.take(pa.array(unseen))
        lines = pa.compute.match_substring(new, "\n").to_numpy(zero_copy_only=False)
        order = np.concatenate((np.flatnonzero(~lines), np.flatnonzero(lines)))
        new = new.take(pa.array(order))
        listed, first = _strings(new), len(new) - int(lines.sum())
        flat, sizes = self._learned(listed[:first], listed[first:])
        number[unseen[order]] = len(self.known) + np.arange(len(new))
        flat, sizes = np.concatenate((self.flat, flat)), np.concatenate((self.sizes, sizes))
        out, each = gathered(flat, sizes, number)
        if len(sizes) <= CACHE:
            kept, mine = pa.concat_arrays([self.known, new]), (flat, sizes)
        elif len(words) <= CACHE:
            kept, mine = words, (out, each)
        else:
            kept, mine = words.slice(0, 0), (out[:0], each[:0])
        short = np.flatnonzero(pa.compute.utf8_length(kept).to_numpy() <= LONGEST)
        if len(short) < len(kept):
            kept, mine = kept.take(pa.array(short)), gathered(*mine, short)
        self.known, (self.flat, self.sizes) = kept, mine
        return out, each

    def _joined(self, words: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of stretches that have ``counts`` of the pre-tokens each, and how
        many each has."""
        coded = words.dictionary_encode()
        out, each = gathered(*self._looked_up(coded.dictionary), coded.indices.to_numpy())
        return out, np.diff(np.concatenate(([0], np.cumsum(each)))[np.concatenate(([0], np.cumsum(counts)))])

    def _pre_tokens(self, text: str) -> list[str]:
        return self.find_ascii(text) if text.isascii() else self.findall(text)

    def encode(self, text: str) -> bytes:
        """Ids of one text as unsigned numbers of ``width`` bytes, low byte first."""
        return self.encode_all(pa.array([text], pa.string()))[0].tobytes()

    def encode_all(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text."""
        if not self.split:
            return [self._whole(t) for t in texts.to_pylist()]
        if not len(texts):
            return []
        listed = pa.compute.split_pattern(texts, " ")
        starts = listed.offsets.to_numpy()[:-1] - listed.offsets[0].as_py()
        parts = listed.flatten()
        coded = parts.dictionary_encode()
        codes = coded.indices.to_numpy()
        stretches = coded.dictionary
        last = pa.compute.utf8_slice_codeunits(stretches, -1)
        heads = pa.compute.utf8_slice_codeunits(stretches, 0, -1)
        alone = pa.compute.utf8_is_alpha(stretches)
        ended = pa.compute.and_(pa.compute.is_in(last, value_set=pa.array([",", "."])), pa.compute.utf8_is_alpha(heads))
        odd = pa.compute.or_(pa.compute.equal(stretches, ""), pa.compute.utf8_is_space(last))
        alone, ended, odd = (x.to_numpy(zero_copy_only=False) for x in (alone, ended, odd))
        # a space and a word; a space, a word and a sign; all other stretches
        kinds = [np.flatnonzero(alone), np.flatnonzero(ended), np.flatnonzero(~(alone | ended))]
        spaced = lambda x: pa.compute.binary_join_element_wise("", x, " ")
        signs = pa.concat_arrays([spaced(heads.take(pa.array(kinds[1]))), last.take(pa.array(kinds[1]))])
        signs = signs.take(pa.array(np.arange(len(signs)).reshape(2, -1).T.ravel()))
        others = [[] if o else self._pre_tokens(" " + s) for s, o in zip(_strings(stretches.take(pa.array(kinds[2]))), odd[kinds[2]].tolist())]
        # a text's first stretch has no space before it: an entry of its own
        others += [self._pre_tokens(f) for f in _strings(parts.take(pa.array(starts)))]
        counts = np.concatenate((np.repeat((1, 2), (len(kinds[0]), len(kinds[1]))), np.fromiter(map(len, others), np.int64, len(others))))
        words = pa.concat_arrays([spaced(stretches.take(pa.array(kinds[0]))), signs, pa.array(chain.from_iterable(others), pa.string())])
        del others, signs, heads, last
        flat, sizes = self._joined(words, counts)
        number = np.empty(len(stretches), np.int32)
        number[np.concatenate(kinds)] = np.arange(len(stretches), dtype=np.int32)
        bad = np.logical_or.reduceat(odd[codes], starts) & (np.diff(np.append(starts, len(codes))) > 1)
        codes = number[codes]
        codes[starts] = len(stretches) + np.arange(len(starts))
        ids, each = gathered(flat, sizes, codes)
        stops = np.cumsum(each)[np.append(starts[1:], len(codes)) - 1].tolist()
        out = [ids[a:b] for a, b in zip([0, *stops[:-1]], stops)]
        listed, where, size = [], [], 0
        for k in (last_bad := np.flatnonzero(bad).tolist()):
            listed.append(self._pre_tokens(texts[k].as_py()))
            where.append(k)
            size += len(listed[-1])
            if size >= TOGETHER or k == last_bad[-1]:
                ids, each = self._joined(pa.array(chain.from_iterable(listed), pa.string()), np.array([len(x) for x in listed]))
                for at, own in zip(where, np.split(ids, np.cumsum(each)[:-1])):
                    out[at] = own
                listed, where, size = [], [], 0
        if self.special:
            whole = pa.compute.match_substring_regex(texts, "|".join(map(re.escape, self.special))).to_numpy(zero_copy_only=False)
            for k in np.flatnonzero(whole).tolist():
                out[k] = self._whole(texts[k].as_py())
        return out

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.type)


def gathered(flat: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entries by number, one behind the other, and the size of each; ``flat``
    has all entries, ``sizes`` how long they are."""
    each = sizes[index]
    ends = np.cumsum(each)
    total = int(ends[-1]) if len(ends) else 0
    # the places of a chunk fit 32 bits, which halves the largest arrays
    kind = np.int32 if max(len(flat), total) < 1 << 31 else np.int64
    places = np.repeat(((np.cumsum(sizes) - sizes)[index] - ends + each).astype(kind), each)
    places += np.arange(total, dtype=kind)
    return flat[places], each


def _strings(values: pa.Array) -> list[str]:
    return values.to_numpy(zero_copy_only=False).tolist()


def encoded_chunks(batches: Iterator[pa.RecordBatch], tokenizer: str) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Keys and ids of each text of batches ``key_, text_``, some megabytes of
    text at a time."""
    encoder = kept_in_worker(f"encoder {tokenizer}", lambda: Encoder(tokenizer))

    def chunk(held: list[pa.RecordBatch]) -> tuple[pa.Array, list[np.ndarray]]:
        rows = pa.Table.from_batches(held).combine_chunks()
        return rows.column(0).combine_chunks(), encoder.encode_all(rows.column(1).cast(pa.large_string()).combine_chunks().cast(pa.string()))

    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += pa.compute.sum(pa.compute.binary_length(batch.column(1))).as_py() or 0
        if size >= CHUNK_BYTES:
            yield chunk(held)
            held, size = [], 0
    if held:
        yield chunk(held)


def encode(docs: DataFrame, tokenizer: str, key: str, text: str, end: int | None) -> DataFrame:
    """``key_``, ``ids`` (u16 or u32 bytes, little-endian) of each row; the
    vocabulary decides the width."""
    text_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids in encoded_chunks(batches, tokenizer):
            width = ids[0].itemsize if ids else 2
            last = np.array([] if end is None else [end], f"<u{width}").tobytes()
            values = pa.array([i.tobytes() + last for i in ids], pa.binary())
            yield pa.RecordBatch.from_arrays([keys, values, pa.array([width] * len(ids), pa.int32())], names=["key_", "ids", "width"])

    rows = docs.select(F.col(key).alias("key_"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text_"))
    return rows.mapInArrow(run, f"key_ {docs.schema[key].dataType.simpleString()}, ids binary, width int")


def _of(value: bytes, width: int) -> np.ndarray:
    return np.frombuffer(value, f"<u{width}")


def ranks(encoded: DataFrame) -> DataFrame:
    """``id``, ``n``, ``rank`` of each id, by falling frequency, then id; as
    many rows as the vocabulary has at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids, width in zip(batch.column(0), batch.column(1).to_pylist()):
                found = np.bincount(_of(ids.as_py(), width))
                if len(found) > len(total):
                    total = np.concatenate((total, np.zeros(len(found) - len(total), np.int64)))
                total[: len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["id", "n"])

    counts = encoded.select("ids", "width").mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    return counts.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("n"), "id")) - 1)


def write(docs: DataFrame, path: str, tokenizer: str, key: str = "doc_id", text: str = "text", end: int | None = None,
          block_ids: int = BLOCK_IDS) -> None:
    """Write ``path/blocks``, ``path/parts`` and ``path/ranks``; documents stand in ascending
    order of ``key``, NULL first, ties in the order of their ids' checksum.

    A NULL text is empty and has the end id only.  Encoded ids are written to
    the shared folder first, then counted and dealt out by range of ``key``.
    """
    spark = docs.sparkSession
    encoded = written(encode(docs, tokenizer, key, text, end), "encoded")
    ranks(encoded).write.parquet(f"{path}/ranks")
    table = spark.read.parquet(f"{path}/ranks").select("id", "rank").toPandas()  # bounded by the vocabulary
    of = np.zeros(int(table["id"].max()) + 1 if len(table) else 1, np.uint32)
    of[table["id"].to_numpy()] = table["rank"].to_numpy()
    kind = encoded.schema["key_"].dataType

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0

        def emit(keys: list, ids: list) -> pa.RecordBatch:
            lengths = np.array([len(i) for i in ids], np.uint32)
            block = pack(lengths, of[np.concatenate(ids)])
            return pa.RecordBatch.from_arrays([
                pa.array([part], pa.int32()), pa.array([before], pa.int64()), pa.array([int(lengths.sum())], pa.int64()),
                pa.array([keys], pa.list_(names)), pa.array([block], pa.binary())], names=["part", "in_part", "n_ids", "keys", "block"])

        keys, ids, size, names = [], [], 0, None
        for batch in batches:
            names = batch.schema.field(0).type
            for k, value, width in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                keys.append(k)
                ids.append(_of(value.as_py(), width))
                size += len(ids[-1])
                if size >= block_ids:
                    yield emit(keys, ids)
                    keys, ids, size, before = [], [], 0, before + size
        if keys:
            yield emit(keys, ids)

    order = [F.col("key_").asc_nulls_first(), F.col("tie").asc()]
    dealt = encoded.withColumn("tie", F.xxhash64("ids")).orderBy(*order).select("key_", "ids", "width")
    out = dealt.mapInArrow(blocks, f"part int, in_part bigint, n_ids bigint, keys array<{kind.simpleString()}>, block binary")
    out.write.parquet(f"{path}/blocks")
    parts = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n"))
    # as many rows as there are partitions
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("part_start")).write.parquet(f"{path}/parts")


def read(spark: SparkSession, path: str, ids: bool = True) -> DataFrame:
    """``key``, ``start`` (ids before the document), ``n_tokens``,
    ``ids_crc32`` and, with ``ids``, ``ids ARRAY<BIGINT>`` of every document."""
    table = spark.read.parquet(f"{path}/ranks").select("id", "rank").toPandas()  # bounded by the vocabulary
    of = np.zeros(len(table), np.uint32)
    of[table["rank"].to_numpy()] = table["id"].to_numpy()
    parts = small_side(spark.read.parquet(f"{path}/parts"))
    blocks = spark.read.parquet(f"{path}/blocks").join(parts, "part").select(
        "keys", (F.col("part_start") + F.col("in_part")).alias("block_start"), "block")
    text_batches(spark, 16)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                lengths, numbers = unpack(batch.column(2)[k].as_py())
                values = of[numbers].astype("<u4")
                ends = np.cumsum(lengths.astype(np.int64))
                raw, begins = values.tobytes(), ends - lengths
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                columns = [batch.column(0)[k].values, pa.array(begins + batch.column(1)[k].as_py()), pa.array(lengths.astype(np.int64)), pa.array(sums, pa.int64())]
                if ids:
                    offsets = pa.array(np.concatenate(([0], ends)).astype(np.int32))
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(values.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=["key", "start", "n_tokens", "ids_crc32", "ids"][: len(columns)])

    kind = blocks.schema["keys"].dataType.elementType.simpleString()
    return blocks.mapInArrow(run, f"key {kind}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * ids)


def new_folder(spark: SparkSession) -> str:
    return fresh_path(spark, "token-ids")
