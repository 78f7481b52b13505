"""License scan: sparse TF-IDF cosine of headers and licence files to templates, then directory inheritance.

Only DataFrame functions. The units of a whole text are its lines and sentences,
sentences over several lines, paragraphs (headers, comment signs around them
included) and the text itself. Units and templates (statements, SPDX tags,
standard headers, whole licence texts) are sparse vectors over distinct words,
weighted by inverse document frequency, which is counted over all documents for
the templates' words; any other word has the largest weight. A text that is
mostly licence, or has a licence and a licence file's name, is a licence file:
it grants its licence to its directory and all below, and a file without a
licence of its own takes that of the nearest ancestor directory.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from traitlens.llm.common import written
from traitlens.llm.decontam import text_key
from traitlens.llm.license_texts import TEMPLATES  # noqa: F401

COSINE = 0.75
#: Share of a text's words in licence units from which it is a licence file.
FILE_SHARE = 0.5
FILE_NAME = r"(?i)^(un)?licen[cs]e|^copying"

#: A sentence's end, but not that of "v. 2.0".
STOP = r"(?<=[.!?])\s+(?![0-9])"
#: Ends a paragraph: a line without letters and digits.
BLANK = r"\n[^\p{L}\p{N}\n]*+\n"
LINE, SENTENCE, PARAGRAPH, TEXT = range(4)


def words(text: Column) -> Column:
    """Lower-case words; parts joined by a full stop, plus or hyphen are one ("apache-2.0", "3-clause")."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]++(?:[.+-][\p{L}\p{N}]++)*+"), F.lit(0))


def units(text: Column) -> Column:
    """Array of (kind, s). Units that repeat one of a smaller kind are left out."""
    lines = F.split(text, r"\n|" + STOP, -1)
    paragraphs = F.split(text, BLANK, -1)
    wrapped = F.filter(F.flatten(F.transform(paragraphs, lambda p: F.split(p, STOP, -1))), lambda s: F.contains(s, F.lit("\n")))
    longer = F.filter(paragraphs, lambda p: F.size(F.split(p, STOP, -1)) > 1)
    whole = F.when(F.size(paragraphs) > 1, F.array(text)).otherwise(F.array().cast("array<string>"))
    return F.concat(*(F.transform(found, lambda s, kind=kind: F.struct(F.lit(kind).alias("kind"), s.alias("s")))
                      for kind, found in enumerate((lines, wrapped, longer, whole))))


def needed(name: Column, tokens: Column) -> Column:
    """Words of a template without which a unit cannot be a statement of it: its version, its tag, "license"."""
    version = F.regexp_extract(name, r"(\d+(?:\.\d+)?)", 1)
    return F.array_intersect(tokens, F.array(version, F.regexp_replace(version, r"\.0$", ""), F.lower(name), F.lit("license")))


def template_files(spark: SparkSession, folder: str) -> DataFrame:
    """(name, text) of a folder of whole licence texts, each named for its licence."""
    return spark.read.text(folder, wholetext=True).select(
        F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.txt)?$", 1).alias("name"), F.col("value").alias("text"))


def template_weights(docs: DataFrame, templates: DataFrame, text: str, cosine: float) -> tuple[DataFrame, float]:
    """(t, name, token, weight, norm2, must, probe) and the largest weight.

    A template's words are taken from the least weight on while the sum of their
    squares is below cosine^2 of all; the others are probes. A unit that shares
    only the former with the template cannot reach the cosine (Cauchy-Schwarz),
    so a unit meets a template only where it has one of its probes.
    """
    tokens = F.array_distinct(words(F.col("text")))
    parts = templates.where("name is not null and text is not null").select("name", "text").distinct() \
        .select(F.xxhash64("name", "text").alias("t"), "name", tokens.alias("ws")) \
        .select("t", "name", needed(F.col("name"), F.col("ws")).alias("must"), F.explode("ws").alias("token"))
    some = literals(parts)
    n = docs.where(F.col(text).isNotNull()).count()
    seen = docs.select(F.explode(F.array_intersect(words(F.col(text).cast("string")), some)).alias("token")) \
        .groupBy("token").agg(F.count(F.lit(1)).alias("df"))
    weighted = parts.join(seen, "token", "left").withColumn(
        "weight", F.log((n + 1) / (F.coalesce("df", F.lit(0)) + 1)) + 1)
    of = Window.partitionBy("t")
    below = F.sum(F.col("weight") ** 2).over(of.orderBy("weight", "token").rowsBetween(Window.unboundedPreceding, 0))
    weighted = weighted.select("t", "name", "must", "token", "weight", F.sum(F.col("weight") ** 2).over(of).alias("norm2"),
                               below.alias("below"))
    return written(weighted.withColumn("probe", F.col("below") >= max(cosine - 1e-6, 0.0) ** 2 * F.col("norm2")).drop("below"),
                   "template-weights"), math.log(n + 1) + 1


def literals(tokens: DataFrame) -> Column:
    """Literal array of the distinct tokens, which are as many as the templates have, whatever the corpus."""
    found = sorted(r[0] for r in tokens.select("token").distinct().collect())
    return F.array(*map(F.lit, found)) if found else F.array().cast("array<string>")


def statements(docs: DataFrame, templates: DataFrame, text: str = "text", cosine: float = COSINE) -> DataFrame:
    """(text_key, kind, place, n_words, name, score, weight): the best template of every unit near one.

    ``cosine`` is above 0. ``weight`` is the squared weight of the words shared
    with the template; the best has the most of it, then the larger score, then
    the first name. Texts that repeat are scored once.
    """
    weights, most = template_weights(docs, templates, text, cosine)
    some, probes = literals(weights), literals(weights.where("probe"))
    texts = docs.select(F.col(text).cast("string").alias("text")).where(F.col("text").isNotNull()) \
        .where(F.arrays_overlap(words(F.col("text")), probes)).select(text_key(F.col("text")).alias("text_key"), "text")
    unit = ["text_key", "place"]
    found = texts.select("text_key", F.posexplode(units(F.col("text"))).alias("place", "u")) \
        .select("text_key", "place", "u.kind", words(F.col("u.s")).alias("ws")) \
        .where(F.arrays_overlap("ws", probes)) \
        .select("text_key", "place", "kind", F.size("ws").alias("n_words"), F.size(F.array_distinct("ws")).alias("n"),
                F.array_intersect("ws", some).alias("inside"))
    # copies of a text have the same units: one of each is scored
    found = written(found.groupBy(*unit).agg(*(F.first(c).alias(c) for c in ("kind", "n_words", "n", "inside"))), "license-units")
    inside = found.select(*unit, "kind", "n_words", "n", F.explode("inside").alias("token"))
    # words of the templates weigh as counted, all others the most
    norms = inside.join(weights.select("token", "weight").distinct(), "token").groupBy(*unit, "kind", "n_words").agg(
        (F.sum(F.col("weight") ** 2) + (F.first("n") - F.count(F.lit(1))) * most ** 2).alias("own2"))
    needs = weights.select("t", "must").distinct()
    pairs = inside.join(weights.where("probe").select("t", "token"), "token").select(*unit, "t").distinct()
    pairs = pairs.join(found.select(*unit, "inside"), unit).join(needs, "t") \
        .where(F.size(F.array_except("must", "inside")) == 0)
    dots = pairs.select(*unit, "t", F.explode("inside").alias("token")).join(weights.drop("must", "probe"), ["t", "token"]) \
        .groupBy(*unit, "t", "name", "norm2").agg(F.sum(F.col("weight") ** 2).alias("dot"))
    scored = dots.join(norms, unit).withColumn("score", F.round(F.col("dot") / F.sqrt(F.col("norm2") * F.col("own2")), 6)) \
        .withColumn("weight", F.round("dot", 6)).where(F.col("score") >= cosine)
    return scored.groupBy(*unit, "kind", "n_words").agg(best(F.struct("name", "score", "weight")).alias("best")) \
        .select("text_key", "kind", "place", "n_words", "best.*")


def best(found: Column) -> Column:
    return F.min_by(found, F.struct(-F.col("weight"), -F.col("score"), F.col("name")))


def ancestors(path: Column) -> Column:
    """Directories of a path from the nearest up to the root ''."""
    parts = F.split(path, "/", -1)
    return F.transform(F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)),
                       lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def scan(docs: DataFrame, templates: DataFrame, path: Column, key: str = "doc_id", text: str = "text",
         cosine: float = COSINE) -> DataFrame:
    """One row (key, path, own_license, score, is_license_file, inherited_license, inherited_from, license).

    The statement that shares most weight with its template is a text's own
    licence (ties: the larger score, the first name); so does the grant of a
    directory with several licence files follow. A text is a licence file if
    units of one kind hold half of its words, or if it has a licence and its
    file is named for one. Null and empty texts have no licence of their own; a
    null path has no directory and inherits nothing. Null keys and repeated
    rows stay; without documents or templates nothing has a licence.
    """
    found = statements(docs, templates, text, cosine)
    covered = F.greatest(*(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("n_words"))), F.lit(0))
                           for k in (LINE, SENTENCE, PARAGRAPH, TEXT)))
    own = written(found.groupBy("text_key").agg(best(F.struct("name", "score", "weight")).alias("best"),
                                                covered.alias("licensed_words")), "statements")
    home = F.get(ancestors(F.col("path")), F.lit(0))
    rows = docs.select(F.col(key).alias("k"), path.alias("path"), F.col(text).cast("string").alias("text")) \
        .select("k", "path", "text", text_key(F.col("text")).alias("text_key"), home.alias("home"))
    # words are counted only for texts with statements
    is_file = (F.col("licensed_words") >= FILE_SHARE * F.size(words(F.col("text")))) \
        | F.coalesce(F.regexp_extract("path", r"([^/]*)$", 1).rlike(FILE_NAME), F.lit(False))
    rows = written(rows.join(own, "text_key", "left").select(
        "k", "path", "home", "best", (F.col("best").isNotNull() & is_file).alias("is_file")), "licensed")
    grants = rows.where("is_file and path is not null").groupBy(F.col("home").alias("dir")).agg(
        F.min_by("best", F.struct(-F.col("best.weight"), -F.col("best.score"), F.col("best.name"))).alias("grant"))
    grants = written(grants, "grants")
    # directories, not files, meet the grants: each directory's ancestors once
    directories = rows.select("home").where("home is not null").distinct()
    nearest = directories.select("home", F.posexplode(F.concat(F.array("home"), ancestors(F.col("home")))).alias("up", "dir")) \
        .join(grants, "dir").groupBy("home").agg(F.min_by(F.struct("dir", "grant"), "up").alias("near"))
    nearest = written(nearest, "nearest-grants")
    out = rows.join(nearest, "home", "left")
    mine = F.col("best.name")
    theirs = F.when(mine.isNull(), F.col("near.grant.name"))
    return out.select(F.col("k").alias(key), "path", mine.alias("own_license"), F.col("best.score").alias("score"),
                      F.coalesce("is_file", F.lit(False)).alias("is_license_file"),
                      theirs.alias("inherited_license"),
                      F.when(theirs.isNotNull(), F.col("near.dir")).alias("inherited_from"),
                      F.coalesce(mine, theirs).alias("license"))


def document_path() -> Column:
    """A directory tree over documents: source/lang for even ids, source/lang/hundreds for odd ones."""
    return F.concat_ws("/", F.col("source"), F.col("lang"), F.when(
        F.col("doc_id") % 2 != 0, F.floor(F.col("doc_id") / 100).cast("string")), F.col("doc_id").cast("string"))
