"""Flat binary token files.

The corpus is cut into ranges of doc_id.  Each range becomes one flat file of
unsigned little-endian token ids without any header, an index file of 64-bit
offsets (documents + 1 of them, in ids, local to the file) and a small Arrow file
with the doc_ids.  A manifest row per file holds its counts; the global base of a
file is the prefix sum of the counts before it, so no file is ever rewritten.

Reading maps the files into memory; a document is the slice between two offsets.

Recovery: file names carry a random part per task attempt and the manifest lists
only what a successful attempt returned, so a lost or repeated task leaves at most
an unlisted file.

Defined cases: null text is empty text (its row holds the end id alone); equal
doc_ids stay next to each other in order of a hash of their text; null doc_ids come first;
strings of added tokens in a text are those tokens, as the tokenizer library codes them; an empty table
gives an empty manifest; extra columns are not read.  A file is bounded by its range of rows;
rows that share a doc_id, or all of it, are cut into ranges like others.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrubline.llm.common import attempt_name, file_dir, map_arrow, materialize, open_fs, slices

END_ID = 2
MEMO_BYTES = 192 << 20  # that a worker's words and pieces take, each; when it is full the older half goes, which changes only speed
ENTRY = 130  # bytes that a place in a dictionary, a string and its packed ids take besides their characters, about
LONGEST = 64  # characters of a word that is remembered
MANIFEST = "part int, tokens string, offsets string, docs string, width int, n_docs long, n_tokens long"


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one thread per Spark task slot
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WholeTexts:
    """Texts to packed ids by the tokenizer as it is."""

    def __init__(self, tokenizer, code: str):
        self.tokenizer, self.code = tokenizer, code

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False):
            yield struct.pack(f"<{len(e.ids)}{self.code}", *e.ids)


class Memo(dict):
    """text -> packed ids, coded when first asked for; ``trim`` keeps it within ``MEMO_BYTES``."""

    def __init__(self, code):
        self.code, self.characters = code, 0

    def __missing__(self, text: str):
        got = self.code(text)
        if len(text) <= LONGEST:
            self[text] = got
            self.characters += len(text)
        return got

    def held(self) -> int:
        """Bytes of the table; ids take two or four bytes and are no more than the bytes of a text."""
        return 3 * self.characters + ENTRY * len(self)

    def trim(self) -> None:
        while self.held() > MEMO_BYTES:
            for old in list(islice(self, (len(self) + 1) // 2)):
                self.characters -= len(old)
                del self[old]


class ByteLevelWords:
    """The same ids for byte-level BPE tokenizers, with a table of the words that recur.

    Such a tokenizer cuts a text by a fixed pattern and codes each piece by itself.  No
    piece goes across a single blank between two other characters, so words joined by
    single blanks can be coded one by one; texts with other white space beside a blank
    are cut by the pattern.  The pieces are coded by the tokenizer's own model.  Texts in
    which an added token stands go through the tokenizer as they are.
    """

    #: Fixed value: the pattern of the tokenizers library's byte-level pre-tokenizer.
    PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, tokenizer, code: str):
        self.model, self.code = tokenizer.model, code
        self.whole = WholeTexts(tokenizer, code)
        self.added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.cut = regex.compile(self.PATTERN).findall
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; others from 256 on
        others = [b for b in range(256) if b not in plain]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.pieces, self.words = Memo(self.piece), Memo(self.word)

    @classmethod
    def fits(cls, tokenizer) -> bool:
        t = json.loads(tokenizer.to_str())
        pre = t["pre_tokenizer"] or {}
        return (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
                and t["normalizer"] is None and t["model"]["type"] == "BPE" and not t["model"].get("dropout"))

    def piece(self, p: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(p.encode("utf-8", "replace").decode("latin-1").translate(self.letters))]
        return struct.pack(f"<{len(ids)}{self.code}", *ids)

    def by_pattern(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.cut(text)))

    def word(self, w: str) -> bytes | None:
        """A word after a blank, or None if it cannot be coded by itself."""
        if w.isalpha():
            return self.pieces[" " + w]
        if not w or w[0].isspace() or w[-1].isspace():
            return None
        if w[:-1].isalpha():  # letters and one other character: two pieces
            return self.pieces[" " + w[:-1]] + self.pieces[w[-1]]
        return self.by_pattern(" " + w)

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        word = self.words.__getitem__
        for text in texts:
            if any(a in text for a in self.added):
                yield from self.whole.encode([text])
                continue
            first, *rest = text.split(" ")
            if first[:1].isspace() or first[-1:].isspace() or not first:
                yield self.by_pattern(text)
                continue
            try:
                yield b"".join([self.by_pattern(first), *map(word, rest)])
            except TypeError:  # a word that cannot be coded by itself
                yield self.by_pattern(text)
        self.words.trim()
        self.pieces.trim()


_CODERS: dict[tuple[str, int], WholeTexts | ByteLevelWords] = {}


def coder(path: str, end_id: int) -> WholeTexts | ByteLevelWords:
    """The coder of a tokenizer file, kept by the worker process between tasks; ids are packed
    in two bytes where all of them fit, else in four."""
    if (path, end_id) not in _CODERS:
        _CODERS.clear()
        tokenizer = load_tokenizer(path)
        code = "H" if max(tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "I"
        _CODERS[path, end_id] = (ByteLevelWords if ByteLevelWords.fits(tokenizer) else WholeTexts)(tokenizer, code)
    return _CODERS[path, end_id]


def write(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Encode every text and write the files; returns the manifest with ``base`` per file."""
    spark = docs.sparkSession
    folder = file_dir(spark, "tokens")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = coder(tokenizer_path, end_id)
        width, end = struct.calcsize(encoder.code), struct.pack(f"<{encoder.code}", end_id)
        part = TaskContext.get().partitionId()
        names = [attempt_name("part", part, s) for s in (".bin", ".off", ".ids.arrow")]
        fs, root = open_fs(folder)
        total, count, opened = 0, 0, None
        try:
            for whole in batches:
                for batch in slices(whole, "text", 1 << 20):
                    if opened is None:
                        opened = [fs.open_output_stream(f"{root}/{n}") for n in names]
                        ids_out = pa.ipc.new_file(opened[2], pa.schema([batch.schema.field("doc_id")]))
                        opened[1].write(np.zeros(1, "<i8").tobytes())
                    texts = [x or "" for x in batch.column("text").to_pylist()]
                    ends = np.empty(len(texts), "<i8")
                    for i, ids in enumerate(encoder.encode(texts)):
                        opened[0].write(ids + end)
                        total += len(ids) // width + 1
                        ends[i] = total
                    opened[1].write(ends.tobytes())
                    ids_out.write_batch(batch.select(["doc_id"]))
                    count += len(texts)
            if opened is not None:
                ids_out.close()
        finally:
            for f in opened or []:
                f.close()
        if opened is not None:
            yield pa.RecordBatch.from_pylist([dict(part=part, tokens=names[0], offsets=names[1], docs=names[2],
                                                   width=width, n_docs=count, n_tokens=total)],
                                             schema=pa.schema([("part", pa.int32()), ("tokens", pa.string()),
                                                               ("offsets", pa.string()), ("docs", pa.string()),
                                                               ("width", pa.int32()), ("n_docs", pa.int64()),
                                                               ("n_tokens", pa.int64())]))

    # the hash and the row number cut the rows of one doc_id; ranges are sampled, so texts are no part of them
    order = ["doc_id", "_hash", "_row"]
    keyed = docs.select("doc_id", "text").withColumn("_hash", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    manifest = materialize(map_arrow(ordered, run, MANIFEST), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    return (manifest.withColumn("base", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))
            .withColumn("folder", F.lit(folder)))


def open_part(row: dict) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Token ids, offsets and doc_ids of one file, memory-mapped where the store allows."""
    fs, root = open_fs(row["folder"])

    def mapped(name: str, dtype: str) -> np.ndarray:
        with fs.open_input_file(f"{root}/{name}") as f:
            return np.frombuffer(f.read_buffer(), dtype)

    with fs.open_input_file(f"{root}/{row['docs']}") as f:
        ids = pa.ipc.open_file(f).read_all().column(0)
    return mapped(row["tokens"], f"<u{row['width']}"), mapped(row["offsets"], "<i8"), ids


def read(spark: SparkSession, manifest: DataFrame, id_type: T.DataType) -> DataFrame:
    """Per document, from the files: doc_id, start (global), n_tokens, ids_crc32."""
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("start", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids, offsets, docs = open_part(row)
                for at in range(0, len(docs), 8192):
                    o = offsets[at:at + 8193]
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(o[:-1], o[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [docs.slice(at, len(crc)).combine_chunks(), pa.array(o[:-1] + row["base"], pa.int64()),
                         pa.array(np.diff(o), pa.int64()), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = max(1, manifest.count())
    slot = (F.row_number().over(Window.orderBy("part")) - 1).cast("int")
    return map_arrow(manifest.withColumn("slot", slot).repartitionById(files, "slot"), run, schema)
