"""Language identification by Bayesian evidence fusion.

Independent evidence about a document's language adds up as log-likelihoods:

* its text: hashed byte-trigram models, one a language, counted over all documents whose
  declared language is one of ``languages``, and a uniform model for ``und`` (any
  other); long texts count as at most ``evidence`` trigrams, as these are not independent;
* the language its markup or metadata declares;
* the suffix of its address (top-level domain);
* its host: the share of each language among the host's other documents, smoothed
  towards its domain's, the suffix's and the whole corpus's shares, all by grouped
  aggregation of the text evidence.

A document is rejected (``lang_kept`` false) if the winner is ``und`` or its posterior is
below ``least``.

Defined results for unusual input: null, empty and letterless texts have no text
evidence and are ``und``, rejected; null declarations, addresses or hosts are no
evidence; whole texts of any length count; repeated rows each get the same result; an
empty table gives an empty table.  Other columns pass through, whatever their names; the result columns take
the place of input columns of the same names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from helixframe.llm.textbytes import pieces, row_sums, trigrams
from helixframe.runtime import bound_batches, materialize

BITS = 14
#: Trigrams that a text's evidence counts as, at most.
EVIDENCE = 200.0
#: Pseudo-counts: of a trigram, of the shares one level up, and for leaving a document out.
ALPHA, SMOOTH = 0.02, 8.0
#: Hosts up to this number are broadcast with their shares; more are joined by a salted shuffle.
BROADCAST_HOSTS, SALTS = 100_000, 16
#: Languages that country suffixes suggest (fixed values).
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "uk": "en", "us": "en", "ie": "en", "au": "en"}
UND = "und"
OWN = ("lang_id", "lang_posterior", "lang_kept")


def _fold() -> np.ndarray:
    out = np.full(256, 32, np.uint8)
    out[97:123] = np.arange(97, 123)
    out[65:91] = np.arange(97, 123)
    out[128:] = np.arange(128, 256)
    return out


FOLD = _fold()


def _letters(data: np.ndarray) -> np.ndarray:
    """1 where a trigram holds a letter."""
    blank = FOLD[data] == 32
    return (~(blank[:-2] & blank[1:-1] & blank[2:])).astype(np.float64)


def _count(batches, languages: tuple[str, ...]):
    """Trigram counts of the rows of a partition, by declared language."""
    total = np.zeros((len(languages), 1 << BITS))
    for batch in batches:
        declared = np.array([languages.index(x) if x in languages else -1 for x in batch["declared"].to_pylist()])
        at = 0
        for data, offsets in pieces(batch["text"]):
            n, own = len(offsets) - 1, declared[at : at + len(offsets) - 1]
            at += n
            if len(data) < 3:
                continue
            h, use = trigrams(data, FOLD, BITS), _letters(data) > 0
            row = np.repeat(np.arange(n), np.diff(offsets))[: len(h)]
            use &= np.arange(len(h)) + 2 < offsets[1:][row]
            use &= own[row] >= 0
            total += np.bincount(own[row[use]] * (1 << BITS) + h[use], minlength=total.size).reshape(total.shape)
    for k, name in enumerate(languages):
        full = np.flatnonzero(total[k])
        if len(full):
            yield pa.RecordBatch.from_pydict({"declared": pa.array([name] * len(full)), "h": pa.array(full, pa.int32()), "n": pa.array(total[k][full].astype(np.int64))})


def learn(docs: DataFrame, languages: tuple[str, ...], text: Column, declared: Column) -> np.ndarray:
    """Log-likelihoods [language, trigram]; the last row is the uniform model of ``und``."""
    bound_batches(docs.sparkSession)
    known = docs.select(text.alias("text"), declared.alias("declared")).where(F.col("declared").isin(*languages))
    counted = known.mapInArrow(lambda b: _count(b, languages), "declared string, h int, n long").groupBy("declared", "h").agg(F.sum("n").alias("n"))
    total = np.zeros((len(languages), 1 << BITS))
    for r in counted.toLocalIterator():  # at most languages x trigrams rows
        total[languages.index(r["declared"]), r["h"]] = r["n"]
    total += ALPHA
    model = np.log(total / total.sum(1, keepdims=True))
    return np.vstack((model, np.full((1, 1 << BITS), -BITS * np.log(2)))).astype(np.float32)


def text_evidence(model: np.ndarray, text: Column, evidence: float = EVIDENCE) -> Column:
    """array<double>: log-likelihood of the text for each language, tempered, highest 0; null without letters."""

    @F.arrow_udf("array<double>")
    def of(texts: pa.Array) -> pa.Array:
        out = []
        for data, offsets in pieces(texts):
            if len(data) < 3:
                # Too few bytes for a trigram; pad so that one or two letters still count for something.
                data, offsets = np.full(3, 32, np.uint8), np.zeros(len(offsets), np.int64)
            h, use = trigrams(data, FOLD, BITS), _letters(data)
            n = row_sums(use, offsets)
            s = np.stack([row_sums(w[h] * use, offsets) for w in model], 1)
            s *= np.where(n > evidence, evidence / np.maximum(n, 1), 1.0)[:, None]
            s -= s.max(1, keepdims=True)
            out += [x if k else None for x, k in zip(s.tolist(), n.tolist(), strict=True)]
        return pa.array(out, pa.list_(pa.float64()), size=len(out))

    return of(text)


def host_of(url: Column) -> Column:
    """The host name in an address, lower case; null where there is none."""
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def declared_in(html: Column) -> Column:
    """The primary language that a page's html element declares; null where there is none."""
    found = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    return F.when(found != "", found)


def page_text(html: Column) -> Column:
    """The text of a page without scripts, styles and tags."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&[a-zA-Z#0-9]{1,10};", " ")


def _shares(table: DataFrame, key: str, up: DataFrame | None, up_key: str | None, names: list[str]) -> DataFrame:
    """(key, share of each language) smoothed towards the shares of the level above."""
    n = sum((F.col(f"n_{x}") for x in names), F.lit(0.0))
    if up is None:
        return table.select(key, *((F.col(f"n_{x}") + SMOOTH / len(names)).alias(f"s_{x}") for x in names)).select(key, *((F.col(f"s_{x}") / sum((F.col(f"s_{y}") for y in names), F.lit(0.0))).alias(f"s_{x}") for x in names))
    both = table.join(up.select(F.col(up_key).alias("__up"), *(F.col(f"s_{x}").alias(f"u_{x}") for x in names)), F.col(up_key) == F.col("__up"))
    return both.select(key, *((((F.col(f"n_{x}") + SMOOTH * F.col(f"u_{x}")) / (n + SMOOTH)).alias(f"s_{x}")) for x in names))


def identify(docs: DataFrame, languages: tuple[str, ...] = ("de", "en", "es", "fr"), text: Column | None = None, declared: Column | None = None, host: Column | None = None, least: float = 0.5, trust: float = 0.9, suffix_trust: float = 0.7, evidence: float = EVIDENCE) -> DataFrame:
    """``docs`` with lang_id, lang_posterior and lang_kept.

    ``text``, ``declared`` and ``host`` are expressions over ``docs``; the text models are
    learned from rows that declare one of ``languages``.
    """
    text, none = F.col("text") if text is None else text, F.lit(None).cast("string")
    declared, host = none if declared is None else F.lower(declared), none if host is None else host
    names = [*languages, UND]
    m = len(names)
    kept = [c for c in docs.columns if c.lower() not in OWN]
    model = learn(docs, languages, text, declared)
    # Input columns go by number until the end, so that none has the name of a helper.
    numbered = [F.col(f"`{c}`").alias(f"c{n}") for n, c in enumerate(kept)]
    scored = docs.select(*numbered, text_evidence(model, text, evidence).alias("__t"), declared.alias("__d"), F.coalesce(host, F.lit("")).alias("__h"))
    parts = [F.exp(F.element_at("__t", k + 1)) for k in range(m)]
    soft = scored.select("__h", *((x / sum(parts, F.lit(0.0))).alias(f"p_{n}") for x, n in zip(parts, names, strict=True)))
    tail = F.split(F.col("__h"), r"\.")
    label = lambda k: F.when(F.size(tail) >= k, F.array_join(F.slice(tail, -k, k), ".")).otherwise(F.col("__h"))
    hosts = materialize(soft.groupBy("__h").agg(*(F.coalesce(F.sum(f"p_{n}"), F.lit(0.0)).alias(f"n_{n}") for n in names)).withColumn("__dom", label(2)).withColumn("__suf", label(1)).withColumn("__all", F.lit(1)), "hosts")

    def level(key: str, up: str) -> DataFrame:
        return hosts.groupBy(key).agg(F.first(up).alias(up), *(F.sum(f"n_{n}").alias(f"n_{n}") for n in names)) if key != up else hosts

    every = _shares(hosts.groupBy("__all").agg(*(F.sum(f"n_{n}").alias(f"n_{n}") for n in names)), "__all", None, None, names)
    suffix = _shares(level("__suf", "__all"), "__suf", every, "__all", names)
    domain = _shares(level("__dom", "__suf"), "__dom", suffix, "__suf", names)
    prior = hosts.join(domain.withColumnRenamed("__dom", "__up"), F.col("__dom") == F.col("__up"))
    prior = materialize(prior.select(F.col("__h").alias("__k"), F.array(*(F.col(f"n_{n}") for n in names)).alias("__n"), F.array(*(F.col(f"s_{n}") for n in names)).alias("__u")), "priors")
    if prior.count() <= BROADCAST_HOSTS:
        joined = scored.join(F.broadcast(prior), F.col("__h") == F.col("__k"), "left")
    else:
        salted = prior.withColumn("__s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = scored.withColumn("__r", F.pmod(F.xxhash64("__t"), F.lit(SALTS)).cast("int")).join(salted, (F.col("__h") == F.col("__k")) & (F.col("__r") == F.col("__s")), "left")

    # The host's shares leave out the document's own text evidence.
    total = sum(parts, F.lit(0.0))
    own = [F.coalesce(x / total, F.lit(0.0)) for x in parts]
    left = [F.greatest(F.lit(0.0), F.element_at("__n", k + 1) - own[k]) for k in range(m)]
    whole = sum(left, F.lit(0.0))
    share = [(left[k] + SMOOTH * F.element_at("__u", k + 1)) / (whole + SMOOTH) for k in range(m)]
    rest = (1 - trust) / (m - 1)
    said = F.when(F.col("__d").isin(*languages), F.col("__d")).otherwise(F.lit(UND))
    known = F.create_map(*(F.lit(x) for kv in SUFFIXES.items() for x in kv))
    hint = known[F.element_at(F.split(F.col("__h"), r"\."), -1)]
    logs = []
    for k, n in enumerate(names):
        by_markup = F.when(F.col("__d").isNull(), 0.0).otherwise(F.log(F.when(said == n, F.lit(trust)).otherwise(F.lit(rest))))
        by_suffix = F.when(hint.isin(*languages), F.log(F.when(hint == n, F.lit(suffix_trust)).otherwise(F.lit((1 - suffix_trust) / (m - 1))))).otherwise(0.0)
        logs.append(F.element_at("__t", k + 1) + F.log(F.greatest(share[k], F.lit(1e-9))) + by_markup + by_suffix)
    fused = joined.withColumn("__l", F.array(*logs))
    top = F.array_max("__l")
    best = F.element_at(F.array(*map(F.lit, names)), F.array_position("__l", top).cast("int"))
    posterior = 1 / F.aggregate("__l", F.lit(0.0), lambda s, x: s + F.exp(x - F.array_max("__l")))
    winner = fused.withColumn("__best", F.coalesce(best, F.lit(UND))).withColumn("__p", F.coalesce(posterior, F.lit(1.0)))
    return winner.select(*(F.col(f"c{n}").alias(c) for n, c in enumerate(kept)), F.col("__best").alias("lang_id"), F.col("__p").alias("lang_posterior"), ((F.col("__best") != UND) & (F.col("__p") >= least)).alias("lang_kept"))
