"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are added as log odds for each row: the likelihood of its text under hashed character
trigrams of each language (counted over all training texts by grouped aggregation), the language its markup
declares, the suffix of its address, and a prior of its host. Host priors are smoothed in a hierarchy: a host's
counts lean on its registered domain's, those on its suffix's, those on the whole table's; all come from grouped
aggregation of what the text alone says, and a row's own vote is left out of the counts it meets. How far
declarations and suffixes are trusted is the share of rows in which they agree with the text.

A row whose text has no letters has text evidence of zero. Null or unparsable addresses and declarations give no
evidence; a null host is a host of its own. Repeated rows are judged each. Of languages with equal posteriors the
first by name is taken. Very long texts count whole. An empty table, or no training text, gives null languages.
Working columns have names of their own, so other columns pass or are not read.
"""

from __future__ import annotations

import html as markup

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType

from lahar.llm.common import cut, small_batches

CELLS = 1 << 14
#: A text's trigrams overlap and repeat its words, the more so the longer it is: n of them count as TEMPER * n ** GROWTH.
TEMPER, GROWTH = 0.6, 0.75
#: How often a declared language is right, as is an address suffix that names one, before rows have told: worth as many rows.
TRUST, TRUST_ROWS = {"declared": 0.9, "suffix": 0.7}, 10.0
#: What a host's, a domain's and a suffix's own counts weigh against the level above.
LEAN = 20.0
#: Suffixes that point to a language of another code; other suffixes point to the language of their own code, if any.
SUFFIX_LANGUAGE = {"uk": "en", "us": "en", "au": "en", "ie": "en", "nz": "en", "at": "de", "mx": "es", "ar": "es", "co": "es", "br": "pt", "jp": "ja", "cn": "zh", "kr": "ko", "ua": "uk", "cz": "cs", "dk": "da", "se": "sv"}


def trigram_cells(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed trigrams of the letters of texts (case folded, anything else one space) and how many each text has."""
    folded = [" ".join(filter(None, _words(t))) if t else "" for t in texts]
    points = [np.frombuffer(f" {t} ".encode("utf-32-le"), np.uint32) if t else np.empty(0, np.uint32) for t in folded]
    cells = [((p[:-2] * np.uint32(0x9E3779B1)) ^ (p[1:-1] * np.uint32(0x85EBCA77)) ^ (p[2:] * np.uint32(0xC2B2AE3D))) >> np.uint32(18) if len(p) > 2 else np.empty(0, np.uint32) for p in points]
    return np.concatenate(cells).astype(np.int64) if cells else np.empty(0, np.int64), np.array([len(c) for c in cells], np.int64)


def _words(text: bytes) -> list[str]:
    words = text.decode().lower().split()
    return [w if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).strip() for w in words]


def text_model(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages, log likelihood of each cell in each): counted over all texts with a language, smoothed by one.

    Each task sums its texts into one row of counts for each language; what reaches the driver is the grouped sum,
    one row of CELLS counts for each language.
    """
    small_batches(docs.sparkSession)
    source = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("language"), F.col(text_col).cast("string").alias("words"))

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()
            for lang in sorted(set(langs)):
                cells, _ = trigram_cells([t for t, x in zip(texts, langs, strict=True) if x == lang])
                sums[lang] = sums.get(lang, 0) + np.bincount(cells, minlength=CELLS)
        for lang, c in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([c.astype(np.int64).tobytes()], pa.binary())], ["language", "counts"])

    def total(table: pa.Table) -> pa.Table:
        c = sum(np.frombuffer(x.as_py(), np.int64) for x in table.column("counts"))
        return pa.table({"language": table.column("language")[:1], "counts": pa.array([c.tobytes()], pa.binary())})

    summed = source.mapInArrow(count, "language string, counts binary").groupBy("language").applyInArrow(total, "language string, counts binary")
    rows = sorted((r.language, np.frombuffer(bytes(r.counts), np.int64)) for r in summed.collect())
    counts = np.array([c for _, c in rows], np.float64).reshape(len(rows), CELLS) + 1
    return [lang for lang, _ in rows], np.log(counts / counts.sum(1, keepdims=True))


def host_of(url: Column) -> Column:
    """The host of an address, lower case, without port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def declared_in(html: Column) -> Column:
    """The language that a page's html element declares, its first part, lower case; null if none."""
    lang = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return F.when(lang != "", lang)


def page_text(html: Column) -> Column:
    """Markup without scripts, styles and tags; character references stay."""
    return F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")


def identify(rows: DataFrame, model: tuple[list[str], np.ndarray], id_cols: list[str], text: Column, declared: Column, host: Column, references: bool = False) -> DataFrame:
    """id_cols, language, posterior (of that language), text_language, letters: one row for each row.

    host is a name of dotted parts; its last part is the suffix, its last two the registered domain. With references,
    character references in the text are read as what they stand for. Every text is scored once, and what it says is
    written to the shared folder, as both host priors and rows need it.
    """
    languages, table = model
    spark = rows.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast(table.astype(np.float32))
    n = len(languages)
    parts = F.split("host", r"\.")
    source = rows.select(
        F.struct(*id_cols).alias("own"), F.lower(declared.cast("string")).alias("declared"), host.cast("string").alias("host"), text.cast("string").alias("words")
    )

    def likelihood(batches):
        for batch in batches:
            texts = batch.column(3).cast(pa.binary()).to_pylist()
            if references:
                texts = [markup.unescape(t.decode()).encode("utf-8", "replace") if t and b"&" in t else t for t in texts]
            cells, sizes = trigram_cells(texts)
            sums = np.zeros((len(sizes), max(n, 1)))
            ends = np.concatenate([[0], np.cumsum(sizes)])
            for k in range(n):
                line = np.concatenate([[0.0], np.cumsum(shared.value[k][cells], dtype=np.float64)])
                sums[:, k] = line[ends[1:]] - line[ends[:-1]]
            sums *= (TEMPER * np.maximum(sizes, 1) ** (GROWTH - 1))[:, None]
            flat = pa.array(sums[:, :n].ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1) * n, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([*[batch.column(j) for j in range(3)], pa.array(sizes), lists], ["own", "declared", "host", "letters", "logs"])

    out = StructType([*source.schema.fields[:3]]).add("letters", LongType()).add("logs", ArrayType(DoubleType()))
    seen = source.mapInArrow(likelihood, out)
    if not n:
        return seen.select("own.*", F.lit(None).cast("string").alias("language"), F.lit(None).cast("double").alias("posterior"), F.lit(None).cast("string").alias("text_language"), "letters")

    def best(scores: Column) -> Column:
        return F.when(F.size(scores) > 0, F.element_at(F.array(*[F.lit(x) for x in languages]), F.array_position(scores, F.array_max(scores)).cast("int")))

    seen = seen.withColumn("text_language", F.when(F.col("letters") > 0, best(F.col("logs"))))
    last = F.element_at(parts, -1)
    points = F.create_map(*[F.lit(x) for pair in SUFFIX_LANGUAGE.items() for x in pair])
    seen = seen.withColumn("domain", F.concat_ws(".", F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2))).withColumn("ending", last)
    seen = cut(seen.withColumn("suffix", F.coalesce(points[last], last)), "langid-seen")
    names = F.array(*[F.lit(x) for x in languages])
    # grouped aggregation: how often each language is what the text says, by host, domain, suffix and in all
    hits = [F.coalesce(F.sum((F.col("text_language") == x).cast("double")), F.lit(0.0)).alias(f"n{k}") for k, x in enumerate(languages)]
    again = [F.sum(f"n{k}").alias(f"n{k}") for k in range(n)]
    by_host = seen.groupBy("host", "domain", "ending").agg(*hits)
    by_domain, by_ending = by_host.groupBy("domain", "ending").agg(*again), by_host.groupBy("ending").agg(*again)
    by_all = by_ending.agg(*again)

    def counts(df: DataFrame, keys: list[str], name: str, prefix: str) -> DataFrame:
        return df.select(*[F.col(k).alias(f"{prefix}{k}") for k in keys], F.array(*[F.col(f"n{k}") for k in range(n)]).alias(name))

    hosts = counts(by_host, ["host", "domain", "ending"], "in_host", "of_")
    domains, endings = counts(by_domain, ["domain", "ending"], "in_domain", "d_"), counts(by_ending, ["ending"], "in_ending", "e_")
    hosts = hosts.join(domains, F.col("of_domain").eqNullSafe(F.col("d_domain")) & F.col("of_ending").eqNullSafe(F.col("d_ending")))
    hosts = hosts.join(endings, F.col("of_ending").eqNullSafe(F.col("e_ending"))).crossJoin(F.broadcast(counts(by_all, [], "in_all", "")))  # one row
    hosts = hosts.select("of_host", "in_host", "in_domain", "in_ending", "in_all")
    both = seen.join(hosts, F.col("host").eqNullSafe(F.col("of_host")), "left")
    vote = F.transform(names, lambda x: F.coalesce((x == F.col("text_language")).cast("double"), F.lit(0.0)))
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    less = lambda a: F.zip_with(F.coalesce(a, vote), vote, lambda c, v: c - v)
    for c in ("in_host", "in_domain", "in_ending", "in_all"):
        both = both.withColumn(c, less(F.col(c)))
    both = both.withColumn("prior", F.transform("in_all", lambda c: (c + 1) / (total(F.col("in_all")) + n)))

    def smoothed(counts: str) -> Column:
        return F.zip_with(counts, "prior", lambda own, up: (own + up * LEAN) / (total(F.col(counts)) + LEAN))

    for c in ("in_ending", "in_domain", "in_host"):
        both = both.withColumn("prior", smoothed(c))

    known = lambda what: F.coalesce(F.array_contains(names, F.col(what)), F.lit(False)) & F.col("text_language").isNotNull()
    told = [x for what in TRUST for x in (F.sum(known(what).cast("double")), F.sum((known(what) & (F.col(what) == F.col("text_language"))).cast("double")))]
    sums = [x or 0.0 for x in seen.agg(*told).head()]
    trust = {what: (right + TRUST[what] * TRUST_ROWS) / (rows_known + TRUST_ROWS) for what, rows_known, right in zip(TRUST, sums[::2], sums[1::2], strict=True)}

    def says(what: str) -> Column:
        named = F.coalesce(F.array_contains(names, F.col(what)), F.lit(False))
        share = min(max(trust[what], 0.5), 1 - 1e-6)
        return F.transform(names, lambda x: F.when(named, F.when(x == F.col(what), F.log(F.lit(share))).otherwise(F.log(F.lit((1 - share) / max(1, n - 1))))).otherwise(F.lit(0.0)))

    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    logs = add(add(F.col("logs"), F.transform("prior", lambda p: F.log(p))), add(says("declared"), says("suffix")))
    fused = both.withColumn("fused", logs).withColumn("most", F.array_max("fused"))
    fused = fused.withColumn("posterior", 1 / F.aggregate(F.transform("fused", lambda x: F.exp(x - F.col("most"))), F.lit(0.0), lambda a, x: a + x))
    return fused.select("own.*", best(F.col("fused")).alias("language"), "posterior", "text_language", "letters")
