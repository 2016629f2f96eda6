"""Language identification by compression with per-language raw-content dictionaries.

A text is compressed once with each language's dictionary; the language whose dictionary
gives the fewest bytes is chosen. A text is rejected when the runner-up comes too close.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from riskloom.llm.common import some_texts

UNKNOWN = "und"
_NO_LETTERS = re.compile(r"[\W\d_]+")


@dataclass(frozen=True)
class LanguageModel:
    """Dictionary content by language and the settings of the compressor.

    ``margin``: a text is rejected when the best size is not smaller than the second best by
    this share. Sizes are whole bytes, so the margin of a short text says nothing: texts of fewer than
    ``judged_bytes`` prepared bytes are never rejected for it. Texts are compressed whole, in blocks of ``block`` bytes, so a dictionary counts
    as much at the end of a long text as at its start.
    """

    dictionaries: dict[str, bytes]
    level: int = 6
    block: int = 4096
    margin: float = 0.005
    judged_bytes: int = 200
    sharpness: float = 12.0


def prepared(text: str) -> bytes:
    """Lower case, with every run of non-letters as one space."""
    return _NO_LETTERS.sub(" ", text.lower()).encode("utf-8", "replace")


def fit(
    rows: DataFrame, text: str = "text", lang: str = "lang", *, texts_per_language: int = 256,
    chars_per_text: int = 512, max_languages: int = 200, **settings,
) -> LanguageModel:
    """Build the dictionaries from a bounded sample of labelled rows.

    Per language the ``texts_per_language`` different texts with the smallest hashes give the
    ``chars_per_text`` characters around their middle. Copies of a text count once, so a large
    group of copies can't fill a dictionary. Only these pieces reach the driver, at most
    ``texts_per_language * max_languages`` of them; more languages are an error. Rows with null
    text, null language or no letter teach nothing; no rows give a model without languages.
    """
    usable = rows.where(F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}")).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("hash")
    )
    different = usable.groupBy("lang", "hash").agg(F.count(F.lit(1)).alias("copies"))
    # Smallest hashes of each bucket first, then of each language: no task sees more than its share of the
    # buckets, however many tasks or texts there are.
    for keys in (["lang", F.pmod("hash", F.lit(64))], ["lang"]):
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("hash"))
        different = different.withColumn("place", place).where(F.col("place") <= texts_per_language).select("lang", "hash")
    chosen = different
    chosen = chosen.limit(texts_per_language * max_languages + 1).collect()
    if len(chosen) > texts_per_language * max_languages:
        raise ValueError(f"more than {max_languages} languages")
    if not chosen:
        return LanguageModel({}, **settings)
    keys = F.broadcast(rows.sparkSession.createDataFrame(chosen, "lang string, hash long"))
    first = F.greatest(F.lit(1), ((F.length("text") - chars_per_text) / 2).cast("int") + 1)
    piece = F.substring(F.col("text"), first, F.lit(chars_per_text))
    samples = usable.join(keys, ["lang", "hash"]).groupBy("lang", "hash").agg(F.min(piece).alias("piece"))
    parts: dict[str, list[tuple[int, bytes]]] = {}
    for row in samples.collect():
        parts.setdefault(row["lang"], []).append((row["hash"], prepared(row["piece"])))
    return LanguageModel({k: b" ".join(p for _, p in sorted(v)) for k, v in sorted(parts.items())}, **settings)


def _compressors(model: LanguageModel) -> list:
    import zstandard

    out = []
    for content in model.dictionaries.values():
        words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        words.precompute_compress(level=model.level)
        out.append(zstandard.ZstdCompressor(level=model.level, dict_data=words, write_content_size=False, write_dict_id=False))
    return out


def classified(text: str | None, names: list[str], compressors: list, model: LanguageModel) -> tuple[str, float, bool]:
    """Language, score and rejection of one text."""
    if not names or text is None or not any(map(str.isalpha, text)):
        return UNKNOWN, 0.0, True
    data = prepared(text)
    blocks = [data[i : i + model.block] for i in range(0, len(data), model.block)]
    # A block's frame always takes the same few bytes; one byte keeps the shares defined.
    sizes = sorted((1 + sum(max(0, len(c.compress(b)) - 6) for b in blocks), k) for k, c in enumerate(compressors))
    if len(sizes) == 1:
        return names[0], 1.0, False
    share = (sizes[0][0] / sizes[1][0]) ** model.sharpness
    narrow = len(data) >= model.judged_bytes and 1.0 - sizes[0][0] / sizes[1][0] < model.margin
    return names[sizes[0][1]], 1.0 / (1.0 + share), narrow


def predicted(model: LanguageModel, text: str | Column = "text") -> Column:
    """Struct ``lang, score, rejected`` of a text column.

    Null, empty and letterless texts are ``und`` with score 0 and are rejected, as is everything
    under a model without languages. Equal sizes go to the first language by name, rejected unless
    the text is short. The classifier counts as non-deterministic, so a filter on its result isn't
    evaluated a second time beside it.
    """

    @F.arrow_udf("lang string, score double, rejected boolean")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, compressors = list(model.dictionaries), _compressors(model)
        for column in batches:
            found = [classified(t, names, compressors, model) for texts in some_texts(column) for t in texts]
            kinds = (("lang", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_()))
            yield pa.StructArray.from_arrays(
                [pa.array([f[i] for f in found], kind) for i, (_, kind) in enumerate(kinds)], names=[n for n, _ in kinds]
            )

    return run.asNondeterministic()(F.col(text) if isinstance(text, str) else text)


def identify(docs: DataFrame, model: LanguageModel, text: str = "text", out: str = "language") -> DataFrame:
    """All rows and columns with the struct ``out`` (a column of that name is replaced); see ``predicted``."""
    return docs.withColumn(out, predicted(model, text))
