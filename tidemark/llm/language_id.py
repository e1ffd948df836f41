"""Language ID by compression with per-language zstandard dictionaries.

Fitting takes a bounded sample of whole labelled texts: of each language's rows,
in order of a hash of doc_id, the first whose texts fill `sample_chars`
characters, at most `sample_docs`. Texts over `long_chars` characters are taken
only of a language that has no shorter one. Sentences that the samples of two
languages share (licences, boilerplate) tell no language and go; what is left,
once each, in lower case and with runs of other characters than letters as one
space, is the language's raw-content dictionary. Prediction brings every whole
text to the same form and compresses it, in blocks of `block` bytes, with each
dictionary; the smallest total wins. A prediction is rejected when the text is
null or has no letter (`und`; letters are the Unicode categories L), or when the
best total is not at least `margin` below the next (a text that compresses alike
under two languages, such as mere markup). Only the text is used.

Ties go to the first language in code point order. score is the softmax of the
saving of each language, in bits for each input byte times `sharpness`. With
one learned language nothing is rejected for margin. With none all is `und`,
and only texts without a letter are rejected. Rows are kept one for one, repeated
ones too; columns that clash with the added ones are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import bounded

OTHERS = re.compile(r"[\W\d_]+")


def plain(text: str) -> str:
    return OTHERS.sub(" ", text.lower())


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def dictionaries(labelled: DataFrame, sample_docs: int = 300, sample_chars: int = 480_000, long_chars: int = 4_000) -> dict[str, bytes]:
    """Dictionary bytes by language, from rows (doc_id, text, lang)."""
    labelled = labelled.where(F.col("lang").isNotNull() & (F.length("text") > 0)).select("doc_id", "text", "lang", (F.length("text") > long_chars).alias("long"), F.length("text").alias("chars"))
    sizes = labelled.groupBy(F.col("lang").alias("of")).agg(F.count_if(~F.col("long")).alias("short"), F.count(F.lit(1)).alias("all"))
    share = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(2)), 11) / F.lit(float(1 << 53))
    # Hashes above four times the share that is wanted cannot be among the smallest; they go before anything is shuffled.
    low = labelled.join(bounded(sizes, 10_000), F.col("lang") == F.col("of")).withColumn("share", share)
    low = low.where((~F.col("long") | (F.col("short") == 0)) & (F.col("share") * F.when(F.col("short") > 0, F.col("short")).otherwise(F.col("all")) < 4 * sample_docs))
    ahead = W.partitionBy("lang").orderBy("share", "doc_id", "text")
    rows = (
        low.withColumns({"k": F.row_number().over(ahead), "before": F.sum("chars").over(ahead.rowsBetween(W.unboundedPreceding, -1))})
        .where((F.col("k") <= sample_docs) & (F.coalesce("before", F.lit(0)) < sample_chars)).orderBy("lang", "k").select("lang", F.col("text").alias("piece")).collect()
    )
    sentences = [(r["lang"], dict.fromkeys(x.strip() for x in re.split(r"[.\n]", plain_lines(r["piece"])) if x.strip())) for r in rows]
    out: dict[str, dict[str, None]] = {}
    for lang, of in sentences:
        out.setdefault(lang, {}).update(of)
    spoken_in = Counter(x for of in out.values() for x in of)
    return {lang: " ".join(x for x in of if spoken_in[x] == 1).encode() for lang, of in sorted(out.items())}


def plain_lines(text: str) -> str:
    """plain(), but for the ends of sentences."""
    return re.sub(r"[^.\n\w]|[\d_]", " ", text.lower())


def identify(docs: DataFrame, dicts: dict[str, bytes], margin: float = 0.001, block: int = 2048, level: int = 6, sharpness: float = 40.0, prefix: str = "") -> DataFrame:
    """docs with columns lang_pred, score, lang_margin, lang_rejected, after `prefix` (these replace columns of the same names)."""
    names = sorted(k for k, v in dicts.items() if len(v) >= 8)  # the least that a dictionary can hold
    added = [prefix + c for c in ("lang_pred", "score", "lang_margin", "lang_rejected")]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    place = [c.lower() for c in docs.columns].index("text")
    shared = docs.sparkSession.sparkContext.broadcast(dicts)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        coders = []
        for name in names:
            d = zstandard.ZstdCompressionDict(shared.value[name], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            coders.append(zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False))
        for b in batches:
            lang, score, gap, rejected = [], [], [], []
            for text in b.column(place):
                text = text.as_py()
                if not text or not names or not has_letter(text):
                    lang.append("und"), score.append(0.0), gap.append(0.0), rejected.append(not text or not has_letter(text))
                    continue
                raw = plain(text).encode()
                blocks = [raw[i : i + block] for i in range(0, len(raw), block)]
                sizes = np.array([sum(len(c.compress(x)) for x in blocks) for c in coders], float)
                best = int(sizes.argmin())
                rest = np.delete(sizes, best)
                space = float((rest.min() - sizes[best]) / rest.min()) if len(rest) else 1.0
                odds = np.exp(sharpness * 8 * (sizes[best] - sizes) / len(raw))
                lang.append(names[best]), score.append(float(1 / odds.sum())), gap.append(space), rejected.append(space < margin)
            arrays = [*b.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(gap, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, [*b.schema.names, *added])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(predict, f"{fields}, {', '.join(f'`{c}` {kind}' for c, kind in zip(added, ('string', 'double', 'double', 'boolean'), strict=True))}")


def recognised(docs: DataFrame, dicts: dict[str, bytes]) -> DataFrame:
    """The rows of docs that are not rejected, with the columns of docs."""
    return identify(docs, dicts, prefix="_found_").where("not _found_lang_rejected").select(*docs.columns)


def held_out(remainder: int, modulus: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus)) == remainder, F.lit(False))
