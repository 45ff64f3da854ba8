"""Language identification by Bayesian evidence fusion.

For every record (a document or a page) four kinds of evidence are added in logarithms, per language:

* text: hashed letter trigrams of the whole text, naive Bayes, times ``TEXT_WEIGHT`` because neighbouring
  trigrams overlap. The model is fitted on a bounded sample of labelled documents.
* declared language (``<html lang>``, or the ``lang`` column of documents): P(declared | language).
* address suffix (last part of the host): P(suffix | language), with weight ``SUFFIX_WEIGHT``.
* host prior, smoothed in levels: a host's counts are filled up with ``STRENGTH`` counts of its domain's
  distribution, the domain's with those of the whole table. A record's own vote is left out of its host's and
  domain's counts.

The counts of the last three are grouped aggregations over the first guesses of all records by text alone, so they
cover the whole table. A further class without language ("und") has a flat distribution of trigrams and a small
prior; records that fall there, or hold no letter, are rejected.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .html_text import decoded

SLOTS, SLICE = 1 << 15, 1 << 20
#: Bound of the fitted sample: about so many labelled documents of every language.
SAMPLE_DOCS = 1000
TEXT_WEIGHT, SUFFIX_WEIGHT, STRENGTH, UNKNOWN, SURE = 0.3, 0.5, 10.0, 1e-4, 0.9
SEED = 5


def letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(1 << 16)])


def trigrams(text: str | None, letter: np.ndarray):
    """Slots of the letter trigrams of a text, a slice at a time. Other characters separate words like one blank."""
    text = (text or "").lower()
    for at in range(0, len(text), SLICE):
        code = np.frombuffer(("\0" + text[max(0, at - 2):at + SLICE] + "\0").encode("utf-32-le", "replace"), np.uint32)
        known = letter[np.minimum(code, 0xFFFF)] | (code > 0xFFFF)
        code = np.where(known, code, 0)
        keep = known.copy()
        keep[1:] |= known[:-1]
        keep[0] = True
        code = code[keep]
        if len(code) > 2:
            a, b, c = code[:-2], code[1:-1], code[2:]
            mixed = (a * np.uint32(0x9E3779B1)) ^ (b * np.uint32(0x85EBCA6B)) ^ (c * np.uint32(0xC2B2AE35))
            yield ((mixed ^ (mixed >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(17)).astype(np.int64)


def fit_text(docs: DataFrame, text_column: str = "text", label_column: str = "lang", id_column: str = "doc_id"):
    """Languages and their log probabilities of trigram slots, from a bounded sample of labelled documents."""
    label = F.lower(F.regexp_extract(F.col(label_column).cast("string"), "^[A-Za-z]{2,3}", 0))
    rows = docs.select(F.col(id_column).cast("string").alias("id"), label.alias("lang"), F.col(text_column).cast("string").alias("text"))
    known = common.store(rows.where("lang <> ''").groupBy("lang").count(), "languages")  # at most 27^3 values of two or three letters
    languages = sorted(r["lang"] for r in known.collect())
    if not languages:
        return [], np.empty((0, SLOTS), np.float32)
    chance = F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.join(F.broadcast(known), "lang").where(chance < F.lit(float(SAMPLE_DOCS)) / F.col("count"))

    def count(frames):
        """Counts of each run of rows of one language."""
        letter, lang, mine = letters(), None, None
        for frame in frames:
            for now, text in zip(frame["lang"], frame["text"]):
                if now != lang:
                    if lang is not None:
                        yield pd.DataFrame({"lang": [lang], "counts": [mine.tobytes()]})
                    lang, mine = now, np.zeros(SLOTS, np.int64)
                for slots in trigrams(text, letter):
                    mine += np.bincount(slots, minlength=SLOTS)
        if lang is not None:
            yield pd.DataFrame({"lang": [lang], "counts": [mine.tobytes()]})

    def together(frame: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(c, np.int64) for c in frame["counts"])
        return pd.DataFrame({"lang": frame["lang"].iloc[:1], "counts": [total.tobytes()]})

    parts = (sample.select("lang", "text").repartition(8, "lang", F.pmod(F.xxhash64("id"), F.lit(8))).sortWithinPartitions("lang")
             .mapInPandas(count, "lang string, counts binary"))
    table = np.zeros((len(languages), SLOTS), np.float64)
    place = {x: i for i, x in enumerate(languages)}
    for r in parts.groupBy("lang").applyInPandas(together, "lang string, counts binary").toLocalIterator():
        table[place[r["lang"]]] = np.frombuffer(r["counts"], np.int64)
    # a tenth of an observation per slot; one per slot would flatten small samples
    table += 0.1
    return languages, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)


def text_evidence(records: DataFrame, model: np.ndarray) -> DataFrame:
    """Records without their text: ``evidence`` (log likelihood per language, last the flat class) and ``n_trigrams``."""
    carried = records.sparkSession.sparkContext.broadcast(model)  # 128 kB a language

    def score(frames):
        letter, table = letters(), np.ascontiguousarray(carried.value.T)
        for frame in frames:
            out, counts = [], []
            for kind, text in zip(frame["kind"], frame["text"]):
                total, n = np.zeros(table.shape[1]), 0
                for slots in trigrams(decoded(text) if kind == "page" and text else text, letter):
                    seen = np.bincount(slots, minlength=SLOTS)
                    some = np.flatnonzero(seen)
                    total += seen[some].astype(np.float64) @ table[some]
                    n += len(slots)
                out.append([*total.tolist(), -n * math.log(SLOTS)])
                counts.append(n)
            yield pd.DataFrame({**{c: frame[c].to_list() for c in ("kind", "id", "declared", "host")}, "evidence": out, "n_trigrams": counts})

    return records.mapInPandas(score, "kind string, id string, declared string, host string, evidence array<double>, n_trigrams long")


def host_parts(host: Column) -> tuple[Column, Column]:
    """Domain (last two parts) and suffix (last part, if two or three letters; else '')."""
    return F.substring_index(host, ".", -2), F.regexp_extract(host, r"\.([a-z]{2,3})$", 1)


def dense(frame: pd.DataFrame, key: str, n: int, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Votes per language for the key of every row, without the row's own vote, and whether the key has any."""
    found = frame[f"{key}_votes"]
    seen = found.notna().to_numpy()
    out = np.zeros((len(frame), n))
    for i, votes in zip(np.flatnonzero(seen), found[seen]):
        for vote in votes:
            out[i, vote["guess"]] = vote["n"]
    mine = np.flatnonzero(seen & (own >= 0))
    out[mine, own[mine]] -= 1
    return out, seen


def identify(records: DataFrame, languages: list[str], model: np.ndarray) -> DataFrame:
    """A row per record (columns ``kind``, ``id``, ``text``, ``declared``, ``host``).

    Returns ``kind``, ``id``, ``lang`` ("und" if rejected), ``probability``, ``text_lang``, ``declared``, ``host``,
    ``n_trigrams`` and ``kept``. Null texts, declarations and hosts count as empty; an empty declaration or host is
    no evidence. Repeated ids are records of their own.
    """
    n = len(languages)
    if not n:
        return records.select("kind", "id", F.lit("und").alias("lang"), F.lit(None).cast("double").alias("probability"), F.lit("und").alias("text_lang"),
                              "declared", "host", F.lit(0).cast("long").alias("n_trigrams"), F.lit(False).alias("kept"))
    plain = records.select("kind", "id", "text", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("declared", "host")])
    scored = text_evidence(plain, model)
    best = F.array_position(F.slice("evidence", 1, n), F.array_max(F.slice("evidence", 1, n))).cast("int") - 1
    top = F.array_max("evidence")
    weight = F.aggregate("evidence", F.lit(0.0), lambda s, x: s + F.exp(F.lit(TEXT_WEIGHT) * (x - top)))
    # first guess by text alone: -1 unless one language is nearly certain
    sure = (F.col("n_trigrams") > 0) & (1 / weight >= SURE) & (F.element_at("evidence", -1) < top)
    domain, suffix = host_parts(F.col("host"))
    scored = common.store(scored.withColumn("guess", F.when(sure, best).otherwise(-1)).withColumn("best", best)
                          .withColumn("domain", F.when(F.col("host") == "", "").otherwise(domain)).withColumn("suffix", suffix), "scored")

    def votes(key: str) -> DataFrame:
        counted = scored.where(f"{key} <> '' AND guess >= 0").groupBy(key, "guess").agg(F.count(F.lit(1)).alias("n"))
        return common.store(counted.groupBy(key).agg(F.collect_list(F.struct("guess", "n")).alias(f"{key}_votes")), f"{key}_votes")

    total = np.zeros(n)
    for r in scored.where("guess >= 0").groupBy("guess").count().collect():
        total[r["guess"]] = r["count"]
    base = (total + 1) / (total.sum() + n)
    joined = scored.join(votes("host"), "host", "left").join(votes("domain"), "domain", "left")
    for key in ("declared", "suffix"):  # at most 27^3 values of two or three letters
        joined = joined.join(F.broadcast(votes(key)), key, "left")

    def fuse(frames):
        names = np.array([*languages, "und"], object)
        for frame in frames:
            if frame.empty:
                continue
            own, evidence = frame["guess"].to_numpy(), np.stack(frame["evidence"])
            prior = base
            for key in ("domain", "host"):
                mine, _ = dense(frame, key, n, own)
                prior = (mine + STRENGTH * prior) / (mine.sum(axis=1, keepdims=True) + STRENGTH)
            other = np.zeros((len(frame), n))
            for key, weight in (("declared", 1.0), ("suffix", SUFFIX_WEIGHT)):
                # log P(value | language) with one added count; the same for all languages where the value has no votes
                mine, seen = dense(frame, key, n, own)
                other[seen] += weight * np.log((mine[seen] + 1) / (total + 2))
            # the class without language has no declaration of its own: it gets the mean likelihood of the declared value
            flat = TEXT_WEIGHT * evidence[:, n] + math.log(UNKNOWN) + other.mean(axis=1)
            scores = np.concatenate([TEXT_WEIGHT * evidence[:, :n] + np.log(prior) + other, flat[:, None]], axis=1)
            place, letters_found = scores.argmax(axis=1), frame["n_trigrams"].to_numpy() > 0
            chance = 1 / np.exp(scores - scores.max(axis=1, keepdims=True)).sum(axis=1)
            yield pd.DataFrame({
                "kind": frame["kind"], "id": frame["id"], "lang": np.where(letters_found, names[place], "und"),
                "probability": [float(c) if ok else None for c, ok in zip(chance, letters_found)],
                "text_lang": np.where(letters_found, names[frame["best"].to_numpy()], "und"), "declared": frame["declared"], "host": frame["host"],
                "n_trigrams": frame["n_trigrams"], "kept": letters_found & (place < n)})

    wanted = ["kind", "id", "evidence", "n_trigrams", "guess", "best", "declared", "host", *[f"{k}_votes" for k in ("host", "domain", "declared", "suffix")]]
    return joined.select(*wanted).mapInPandas(fuse, "kind string, id string, lang string, probability double, text_lang string, declared string, "
                                              "host string, n_trigrams long, kept boolean")


def document_records(docs: DataFrame) -> DataFrame:
    """Documents: their ``lang`` is the declaration, their ``source`` the host."""
    declared = F.lower(F.regexp_extract(F.col("lang").cast("string"), "^[A-Za-z]{2,3}", 0))
    return docs.select(F.lit("document").alias("kind"), F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string").alias("text"),
                       declared.alias("declared"), F.col("source").cast("string").alias("host"))


def page_records(pages: DataFrame) -> DataFrame:
    """Pages: all text outside tags, scripts and styles; ``<html lang>`` and the host of the url."""
    html = F.col("html").cast("string")
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?(</\1\s*>|\z)|<!--.*?(-->|\z)|<[a-z/!][^>]*>", " ")
    declared = F.lower(F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})(?![a-z])", 1))
    host = F.lower(F.regexp_extract(F.col("url").cast("string"), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#]*@)?([^/?#:]+)", 1))
    return pages.select(F.lit("page").alias("kind"), F.col("page_id").cast("string").alias("id"), text.alias("text"), declared.alias("declared"),
                        host.alias("host"))


def keep_known(docs: DataFrame) -> DataFrame:
    """The documents whose language is known, each row by its own text and evidence; rows without an id stay."""
    common.prepare(docs.sparkSession)
    languages, model = fit_text(docs)
    row_id = F.concat_ws(":", F.col("doc_id").cast("string"), F.xxhash64("text", "lang", "source").cast("string"))
    named = docs.select(F.when(F.col("doc_id").isNotNull(), row_id).alias("doc_id"), "text", "lang", "source")
    gone = identify(document_records(named), languages, model).where("NOT kept AND id IS NOT NULL").select(F.col("id").alias("gone_id")).distinct()
    return docs.join(gone, F.col("gone_id") == F.when(F.col("doc_id").isNotNull(), row_id), "left_anti")
