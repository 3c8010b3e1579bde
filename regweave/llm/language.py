"""Language ID by compression: the language whose dictionary makes a text smallest.

Each language gets a zstandard raw-content dictionary of sampled training text. A text is
cut into chunks, each chunk is compressed with every dictionary, and the sizes are summed;
the smallest sum wins. Where the runner-up is nearly as small the answer is marked as not
confident. Documents are scored where they are read; nothing is shuffled.

Fitting reads at most ``max_rows`` different training texts for each language, drawn by a hash
of the text, and takes one slice of each, whole slices up to ``dictionary_bytes``. So all
languages with enough text have dictionaries of about the same size, whatever their script.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regweave.llm.common import LOWER_TABLE, append_columns, small_side

UNDETERMINED = "und"
_LETTER = regex.compile(r"\p{L}")
_CHUNK = 1 << 10
_LEVEL = 6


@dataclass
class Languages:
    """Raw-content dictionaries by language, the language with most training rows first."""

    dictionaries: dict[str, bytes]
    margin: float = 0.01

    def compressors(self) -> dict[str, zstandard.ZstdCompressor]:
        made = {}
        for name, content in self.dictionaries.items():
            data = zstandard.ZstdCompressionDict(
                content, dict_type=zstandard.DICT_TYPE_RAWCONTENT
            )
            data.precompute_compress(level=_LEVEL)
            made[name] = zstandard.ZstdCompressor(
                level=_LEVEL, dict_data=data, write_content_size=False, write_checksum=False,
                write_dict_id=False,
            )
        return made


def fit(
    docs: DataFrame,
    use: Column | None = None,
    text: str = "text",
    lang: str = "lang",
    max_rows: int = 400,
    slice_chars: int = 512,
    dictionary_bytes: int = 192 << 10,
) -> Languages:
    """Dictionaries from rows with text and language; ``use`` says which rows may be used.

    One row per language, and its sampled slices, pass through the driver. Texts are drawn
    with a probability that makes ``4 * max_rows`` different ones likely in each language, of
    which the ``max_rows`` with the smallest hashes are used; a rare language keeps all its
    texts, however often they are repeated.
    """
    training = docs if use is None else docs.where(use)
    training = training.select(F.col(text).alias("t"), F.col(lang).alias("l")).where(
        "l is not null and t is not null and t != ''"
    )
    counts = training.groupBy("l").agg(
        F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("t")).alias("texts")
    )
    draw = F.shiftrightunsigned(F.xxhash64("t"), 2)
    drawn = training.join(small_side(counts, "training-languages"), "l").where(
        draw < F.least(F.lit(1.0), 4.0 * max_rows / F.col("texts")) * float(1 << 62)
    )
    # Copies of one text are one sample, and add nothing to a dictionary.
    place = F.pmod(F.xxhash64("t", F.lit(1)), F.greatest(F.length("t") - slice_chars, F.lit(0)) + 1)
    slices = drawn.select(
        "l", draw.alias("h"), F.substring("t", place.cast("int") + 1, F.lit(slice_chars)).alias("s")
    ).distinct()
    order = counts.orderBy(F.desc("n"), "l").collect()
    found: dict[str, list] = {row["l"]: [] for row in order}
    for row in slices.collect():
        found[row["l"]].append((row["h"], row["s"]))
    dictionaries = {}
    for name, rows in found.items():
        content = b""
        for _, sample in sorted(rows)[:max_rows]:
            data = sample.encode().translate(LOWER_TABLE) + b"\n"
            if len(content) + len(data) > dictionary_bytes:
                break
            content += data
        dictionaries[name] = content
    return Languages(dictionaries)


def identify(docs: DataFrame, languages: Languages, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and confident.

    ``score`` is the saving over the runner-up, 1 - smallest / second; ``confident`` says if
    it reaches the model's margin. NULL texts and texts without a letter, and all texts of
    a model without languages, are ``und`` with score 0. Equal sizes go to the
    language with more training rows. Columns of the new names are replaced.
    """
    made: dict = {}

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if not made:
            made.update(languages.compressors())
        names, scores = [], []
        for value in batch.column(text).to_pylist():
            if not made or not value or not _LETTER.search(value):
                names.append(UNDETERMINED)
                scores.append(0.0)
                continue
            data = value.encode().translate(LOWER_TABLE)
            chunks = [data[i : i + _CHUNK] for i in range(0, len(data), _CHUNK)]
            sizes = sorted(
                (sum(len(packer.compress(chunk)) for chunk in chunks), place, name)
                for place, (name, packer) in enumerate(made.items())
            )
            names.append(sizes[0][2])
            scores.append(1.0 - sizes[0][0] / sizes[1][0] if len(sizes) > 1 else 1.0)
        sure = [name != UNDETERMINED and s >= languages.margin for name, s in zip(names, scores)]
        return [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(sure)]

    return append_columns(docs, "lang_pred string, score double, confident boolean", compute)
