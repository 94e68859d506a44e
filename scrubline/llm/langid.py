"""Language identification by compression.

Every language has a raw-content zstandard dictionary made of short excerpts of
labelled documents.  A text is compressed once per language, in blocks, each
block starting from that dictionary; the language whose dictionary makes the text
smallest wins.  The margin is the share by which the winner beats the runner-up.  Sizes
are whole bytes, so a text whose margin is small is measured again, at a level whose
search finds shorter matches; where the margin is narrow then too the document is rejected.
The rule looks at the margin only, not at the length of the text.

Fit: a bounded sample of labelled rows (``SAMPLE_DOCS`` documents per language,
``EXCERPT`` letters of each); excerpts are short so that a document copied into
another language's rows cannot outweigh the rest.  Prediction: every document,
its whole text, whatever its length.

Defined cases: null text, empty text and text without a letter give ``und``, score
0 and are rejected; ties go to the language first in code point order, score 0; a
model of one language gives it score 1; rows without a label are not learned from;
without any labelled row everything is ``und``; rows that repeat get the same result each.
Extra columns are kept; columns named like the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window
from pyspark.sql.pandas.types import to_arrow_schema

from scrubline.llm.common import map_arrow, set_columns, with_fields

SAMPLE_DOCS = 512  # documents per language in a dictionary, at most
EXCERPT = 160  # letters that one document adds to its dictionary, at most
BLOCK = 8192  # bytes compressed at a time
LEVEL = 6
CLOSE, CLOSE_LEVEL = 0.02, 12  # wins by less are measured again at this level
MIN_MARGIN = 0.001  # narrower wins are rejected
UNDETERMINED = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")
_LETTER = regex.compile(r"\p{L}")
RESULT = (T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
          T.StructField("rejected", T.BooleanType()))


def normalize(text: str) -> bytes:
    """Lower-case words joined by blanks: digits, signs and case say little about the language."""
    return _NOT_LETTERS.sub(" ", text).lower().encode("utf-8", "replace")


def held_out():
    """True for documents that are never learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, excerpt: int = EXCERPT) -> dict[str, bytes]:
    """Dictionary bytes per language from the labelled rows that are not held out.

    Two passes: counts per language (no text is read), then one over the text that
    keeps rows whose hash falls under a rate chosen to leave about twice the sample;
    the exact sample is the first of them in hash order.  What reaches the driver
    is at most languages x sample_docs x excerpt letters.
    """
    usable = docs.filter(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return {}
    rate = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 2.0 * sample_docs / n + 1e-9))])
    order = F.xxhash64(F.col("doc_id").cast("string"))
    draw = F.pmod(order, F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = (usable.filter(draw < F.element_at(rate, F.col("lang")))
            .select("lang", order.alias("h"), F.substring("text", 1, 4 * excerpt).alias("head"))
            .filter(F.col("head").isNotNull())
            .withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "head")))
            .filter(F.col("n") <= sample_docs).select("lang", "h", "head").collect())
    model: dict[str, list[bytes]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["h"], r["head"])):
        model.setdefault(r["lang"], []).append(normalize(r["head"])[:excerpt])
    return {k: b"\n".join(v) for k, v in sorted(model.items())}


def classifier(model: dict[str, bytes], min_margin: float = MIN_MARGIN) -> Callable[[str | None], tuple]:
    """A function text -> (language, score, rejected) for one worker."""
    def coders(level: int) -> list:
        out = []
        for lang, content in model.items():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            p = zstandard.ZstdCompressionParameters.from_level(level, dict_size=len(content), source_size=BLOCK, write_content_size=False)
            d.precompute_compress(compression_params=p)
            out.append((lang, zstandard.ZstdCompressor(dict_data=d, compression_params=p)))
        return out

    usual, fine = coders(LEVEL), coders(CLOSE_LEVEL)

    def measure(blocks: list[bytes], by: list) -> tuple[str, float]:
        sizes = sorted((sum(len(c.compress(b)) for b in blocks), k) for k, c in by)
        return sizes[0][1], 1.0 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0

    def classify(text: str | None) -> tuple:
        if text is None or not model or not _LETTER.search(text):
            return UNDETERMINED, 0.0, True
        data = normalize(text)
        blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
        lang, margin = measure(blocks, usual)
        if margin < CLOSE:
            lang, margin = measure(blocks, fine)
        return lang, margin, margin < min_margin

    return classify


def predict(docs: DataFrame, model: dict[str, bytes], min_margin: float = MIN_MARGIN, keep_rejected: bool = True) -> DataFrame:
    """``docs`` with lang_pred, score (the margin, 0 to 1) and rejected."""
    schema = with_fields(docs.schema, *RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classify, out = classifier(model, min_margin), to_arrow_schema(schema)
        for batch in batches:
            found = [classify(t.as_py()) for t in batch.column("text")]
            lang, score, rejected = (pa.array(list(x), t) for x, t in
                                     zip(zip(*found), (pa.string(), pa.float64(), pa.bool_()))) if found else (
                pa.array([], pa.string()), pa.array([], pa.float64()), pa.array([], pa.bool_()))
            result = set_columns(batch, out, lang_pred=lang, score=score, rejected=rejected)
            yield result if keep_rejected else result.filter(pc.invert(rejected))

    return map_arrow(docs, run, schema)
