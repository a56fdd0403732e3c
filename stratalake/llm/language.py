"""Language identification by compression.

Texts are judged by their letters alone: lower-cased, with one space for whatever stands between words. A
language is a zstandard dictionary of raw text: ``passages`` random passages of ``passage_chars``
characters of its labelled documents (a bounded sample, drawn by a hash over all of them). A
text is cut into blocks, every block is compressed with each language's dictionary, and the
language with the smallest total is chosen. Blocks keep the text from teaching the
compressor itself, so long texts are judged as short ones are.

``score`` is the share of the chosen language when lengths are read as probabilities:
``1 / sum(2 ** -(bytes - least))`` over the languages. A document is rejected where nothing can
be told (no text, no letter), or where the runner-up needs hardly more bytes:
``second - least <= margin * least``. One rule holds for every length, so a tie is always rejected.

Repeated rows get the same answer each; long texts are judged whole, block by block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from . import words
from .store import column, text_slices, with_columns

#: Parameters: the sample of each language, the blocks, the level of compression, the margin.
PASSAGES = 512
PASSAGE_CHARS = 256
BLOCK = 2048
LEVEL = 6
MARGIN = 0.005
UNKNOWN = "und"


def letters(text: str) -> Column:
    """The words of a text in lower case, one space before, between and after them; nothing if there is no letter."""
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" ")), r"[^\p{L}]+", " ")


def train(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", passages: int = PASSAGES, passage_chars: int = PASSAGE_CHARS) -> dict[str, bytes]:
    """The dictionary of each non-null value of ``lang``: at most ``passages * passage_chars`` characters.

    A passage starts at a place that the hash of ``key`` chooses, anywhere in the text. The
    documents with the smallest hashes are taken; documents with no chance (about four times as many
    as needed pass) don't get that far, and each task sends at most ``passages`` rows of a language. Languages with
    more documents come first.
    """
    known = labelled.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    counts = {r[0]: r[1] for r in known.groupBy(lang).agg(F.count("*")).collect()}
    if not counts:
        return {}
    chance = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 4.0 * passages / n))])[F.col(lang)]
    draw = F.xxhash64(F.col(key), F.lit(7)).alias("draw")
    drawn = known.select(F.col(lang).alias("lang"), F.col(text).alias("text"), draw, chance.alias("chance"))
    drawn = drawn.where((F.col("draw") / F.lit(2.0**64) + 0.5) < F.col("chance")).withColumn("text", letters("text"))
    room = F.greatest(F.length("text") - passage_chars, F.lit(0))
    begin = F.pmod(F.shiftright(F.col("draw"), 7), F.greatest(room + 1, F.lit(1)).cast("long")) + 1
    drawn = drawn.select("lang", "draw", F.substr("text", begin.cast("int"), F.lit(passage_chars)).alias("passage"))
    order = W.partitionBy("lang").orderBy("draw", "passage")
    best = drawn.withColumn("n", F.row_number().over(order)).where(F.col("n") <= passages)
    out: dict[str, list[tuple]] = {}
    for r in best.collect():
        out.setdefault(r["lang"], []).append((r["draw"], r["passage"]))
    ranked = sorted(out.items(), key=lambda item: (-counts[item[0]], item[0]))
    return {k: "\n".join(p for _, p in sorted(v)).encode() for k, v in ranked}


class Classifier:
    def __init__(self, dictionaries: dict[str, bytes], level: int = LEVEL, block: int = BLOCK):
        import zstandard

        self.languages, self.block, self.compressors = list(dictionaries), block, []
        for content in dictionaries.values():
            own = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own.precompute_compress(level=level)
            self.compressors.append(zstandard.ZstdCompressor(level=level, dict_data=own, write_content_size=False, write_checksum=False, write_dict_id=False))

    def sizes(self, text: bytes) -> list[int]:
        """Bytes that the text takes with each language's dictionary."""
        out = [0] * len(self.compressors)
        for at in range(0, len(text), self.block):
            piece = text[at : at + self.block]
            for k, c in enumerate(self.compressors):
                out[k] += len(c.compress(piece))
        return out


def classify(
    docs: DataFrame, dictionaries: dict[str, bytes], text: str = "text", margin: float = MARGIN, level: int = LEVEL, block: int = BLOCK, carry: list[str] | None = None
) -> DataFrame:
    """All columns (or those in ``carry``), and ``lang_pred``, ``score``, ``second`` (the runner-up) and ``rejected``.

    Null texts and texts without a letter get ``und`` with score 0 and are rejected; so is everything if
    no language was learned. Ties, as very short texts have them, name the language that comes first in
    ``dictionaries`` and are rejected. Columns of the input with these names are replaced.
    """
    made = {"lang_pred": "string", "score": "double", "second": "string", "rejected": "boolean"}
    keep = [f for f in docs.schema.fields if f.name not in made and (carry is None or f.name in carry)]
    names = [f.name for f in keep]
    schema = T.StructType([*keep, *T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in made.items())).fields])
    plain = "_letters"
    while plain in names:
        plain += "_"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Classifier(dictionaries, level, block)
        for batch in text_slices(batches, plain):
            data, starts = words.text_bytes(column(batch, plain))
            raw = data.tobytes()
            out = []
            for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if hi - lo < 2 or not own.languages:
                    out.append((UNKNOWN, 0.0, None, True))
                    continue
                sizes = own.sizes(raw[lo:hi])
                best, *rest = sorted(range(len(sizes)), key=sizes.__getitem__)
                least = sizes[best]
                score = 1.0 / float(np.sum(np.exp2(-np.minimum(np.array(sizes) - least, 1000.0))))
                second = sizes[rest[0]] if rest else None
                narrow = second is not None and second - least <= margin * least
                out.append((own.languages[best], score, own.languages[rest[0]] if rest else None, narrow))
            made_columns = {n: pa.array([x[i] for x in out], t) for i, (n, t) in enumerate(zip(made, (pa.string(), pa.float64(), pa.string(), pa.bool_()), strict=True))}
            yield with_columns(batch, names, made_columns)

    return docs.select(*names, letters(text).alias(plain)).mapInArrow(run, schema)


def held_out(key: str = "doc_id", folds: int = 5) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, modulo ``folds``, is 0. A null id is held out."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(folds)) == 0


def fit(docs: DataFrame) -> dict[str, bytes]:
    """Dictionaries learned from ``text`` and ``lang`` of the documents that are not held out."""
    return train(docs.where(~held_out()))
