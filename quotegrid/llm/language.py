"""Language identification by compression.

For each language a raw-content dictionary for zstandard is laid together from pieces of a bounded sample of
labelled texts. A text is encoded in blocks with every dictionary, and the language with the fewest bytes
is predicted. Where the margin is narrow, the blocks are encoded once more with more effort, each behind an anchor
that the dictionary holds, so that even a word or two makes a compressed block. A margin that is
still narrow is a rejection: ``accepted`` is false, the nearest language is reported all the same.

Text is lower-cased and cut down to its letters first. Whole texts are encoded, in blocks; learning looks at
``PIECE`` characters of ``PIECES`` texts of a language, texts and places in them chosen by hashes of the text. Equal pieces count once.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is everything if nothing
was learnt; equal sizes go to the language with more labelled texts; repeated rows give repeated rows;
rows without a language are not learnt from; other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotegrid.llm.common import row_slices

PIECES = 256  # texts learnt from for each language
PIECE = 512  # characters of each
BLOCK = 8192
LEVEL, DEEP_LEVEL = 6, 15
ANCHOR = 48
NARROW = 0.02  # of the smallest size; a second look below
REJECT = 0.01  # of the smallest size; not accepted below
SLICE = 1 << 20

_LETTER = regex.compile(r"\p{L}")  # numbers that are words, such as Roman numerals or fractions, are no letters
_ASCII = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def letters(text: str) -> bytes:
    return b" ".join(text.lower().encode().translate(_ASCII).split())


@dataclass(frozen=True)
class LanguageModel:
    """Dictionaries by language, the language with most labelled texts first."""

    dictionaries: dict[str, bytes]

    def compressors(self, level: int) -> dict[str, zstandard.ZstdCompressor]:
        out = {}
        for lang, raw in self.dictionaries.items():
            of = zstandard.ZstdCompressionParameters.from_level(level, write_content_size=0, write_checksum=0, write_dict_id=0)
            held = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=of)
            out[lang] = zstandard.ZstdCompressor(dict_data=held, compression_params=of)
        return out


def learn(labelled: DataFrame) -> LanguageModel:
    """From ``text`` and ``lang``. The driver gets a count and a few hundred pieces of text for each language."""
    rows = labelled.select("text", "lang").where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = sorted(((r["count"], r["lang"]) for r in rows.groupBy("lang").count().collect()), key=lambda x: (-x[0], x[1]))
    if not counts:
        return LanguageModel({})
    share = F.create_map(*[F.lit(x) for n, lang in counts for x in (lang, min(1.0, 4 * PIECES / n))])
    chance = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    places = F.greatest(F.length("text") - PIECE, F.lit(0)) + 1
    start = F.pmod(F.xxhash64("text", F.lit("place")), places).cast("int") + 1
    sampled = rows.select("lang", F.col("text").substr(start, F.lit(PIECE)).alias("piece"), F.xxhash64("text").alias("h"), chance.alias("p"))
    sampled = sampled.where(F.col("p") < share[F.col("lang")])
    pieces: dict[str, list] = {lang: [] for _, lang in counts}
    for r in sampled.groupBy("lang", "h").agg(F.min("p").alias("p"), F.min("piece").alias("piece")).collect():  # copies once
        pieces[r["lang"]].append((r["p"], r["h"], r["piece"]))
    # equal pieces once, and none without a letter
    unique = {lang: [x for x in dict.fromkeys(letters(f[2]) for f in sorted(found)) if x][:PIECES] for lang, found in pieces.items()}
    joined = {lang: b" ".join(found) for lang, found in unique.items()}
    return LanguageModel({lang: raw for lang, raw in joined.items() if len(raw) >= 8})


class Classifier:
    def __init__(self, model: LanguageModel):
        self.model = model
        self.fast, self.deep = model.compressors(LEVEL), model.compressors(DEEP_LEVEL)
        self.anchors = {lang: raw[-ANCHOR:] for lang, raw in model.dictionaries.items()}

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        """Language, score, relative margin, and whether it is accepted."""
        if not text or not self.fast or not _LETTER.search(text):
            return "und", 0.0, 0.0, False
        raw = letters(text)
        blocks = [raw[k : k + BLOCK] for k in range(0, len(raw), BLOCK)]
        size = {lang: sum(len(c.compress(b)) for b in blocks) for lang, c in self.fast.items()}
        first, second = (sorted(size.values()) + [math.inf])[:2]
        if second - first <= max(4, NARROW * first):
            size = {lang: sum(len(c.compress(self.anchors[lang] + b)) for b in blocks) for lang, c in self.deep.items()}
            first, second = (sorted(size.values()) + [math.inf])[:2]
        best = min(size, key=size.__getitem__)  # the first of equals
        odds = sum(math.exp(-0.5 * min(200, n - first)) for n in size.values())
        margin = min(1.0, second / first - 1)
        return best, 1.0 / odds, margin, margin >= REJECT


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score, margin, accepted of each row; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classifier = Classifier(model)
        types = [pa.string(), pa.float64(), pa.float64(), pa.bool_()]
        for part in row_slices(batches, "text", SLICE):
            cols = list(zip(*map(classifier.predict, part.column(1).to_pylist()), strict=True))
            arrays = [pa.array(c, t) for c, t in zip(cols, types, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), *arrays], names=["doc_id", "lang_pred", "score", "margin", "accepted"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, lang_pred string, score double, margin double, accepted boolean"
    )
