"""URL filter by a tree of path templates per host. DataFrame functions only.

Level by level, the segments of the paths below a template become its branches. A segment that
occurs rarely below it is variable and becomes the wildcard ``*``. A frequent one keeps its own
branch only if its labelled pages differ: branches whose share of bad pages is statistically
similar to that of their siblings are merged into the wildcard. A template is rejected if its
share of bad pages, smoothed towards that of its host and of all pages, reaches ``reject``.

A page is labelled by the label of the document that it shows: bad if its quality is 0 or it is
toxic. That document is the one whose number ends the path, as in ``/en/4033`` or
``/en/4033.html``; other ways to name it can be given.
"""

from __future__ import annotations

import itertools
import string
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.llm.shared import stored
from encore.operators.joins import splittable

#: Levels that are always written; wildcards after them and after the last branch are one ``**``.
LEVELS = 4
#: A branch of its own needs so many pages; no share of its parent's is asked for.
LEAST_PAGES = 20
#: Branches differ if the shares of bad pages differ by so many standard errors.
DIFFERENT = 2.58
#: Smoothing: so many pages with the parent's share are added.
SMOOTHING = 10.0
REJECT = 0.5


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The host in lower case (A-Z) and the path; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(
        F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase
    )
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def document_number(path: Column) -> Column:
    """The number that ends a path, before a suffix such as ``.html``; null if there is none."""
    digits = F.regexp_extract(path, r"/([0-9]{1,18})(?:\.[A-Za-z0-9]+)?/?$", 1)
    return F.when(digits != "", digits).cast("long")


def _longest_rule(rules: tuple[Rule, ...]) -> Column:
    ordered = sorted(rules, key=lambda r: (len(r.text), r.text), reverse=True)
    found = F.lit(None).cast("string")
    for rule in reversed(ordered):
        fits = (
            ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host))
            & F.col("path").startswith(rule.path)
        )
        found = F.when(fits, F.lit(rule.text)).otherwise(found)
    return found


def _bad_share(bad: str, labelled: str, prior: Column) -> Column:
    return (F.col(bad) + F.lit(SMOOTHING) * prior) / (F.col(labelled) + F.lit(SMOOTHING))


def _may_split() -> Column:
    """Parents below which a branch can still get a template of its own: enough pages, good and
    bad ones among the labelled, and paths that are not all the same from here on."""
    return (
        (F.col("pn") >= LEAST_PAGES)
        & (F.col("pb") > 0)
        & (F.col("pb") < F.col("pl"))
        & (F.col("first") != F.col("last"))
    )


def templates(pages: DataFrame) -> DataFrame:
    """Adds ``template`` to (page_id, host, path, labelled, bad).

    After the first LEVELS levels only pages below parents that may still split are taken on.
    """
    rows = pages.withColumn(
        "segments", F.filter(F.split("path", "/"), lambda s: s != "")
    ).withColumn("template", F.lit(""))
    rows = rows.withColumn("written", F.lit("")).withColumn("depth", F.lit(LEVELS))
    finished: list[DataFrame] = []
    for level in itertools.count():
        rows = rows.withColumn("segment", F.get("segments", F.lit(level)))
        rest = F.slice("segments", F.lit(level + 1), F.greatest(F.size("segments"), F.lit(1)))
        branches = stored(
            rows.where("segment is not null").groupBy("host", "template", "segment").agg(
                F.count("*").alias("n"), F.sum("labelled").alias("l"), F.sum("bad").alias("b"),
                F.min(rest).alias("first"), F.max(rest).alias("last"),
            ),
            "branches",
        )
        parents = branches.groupBy("host", "template").agg(
            F.sum("n").alias("pn"), F.sum("l").alias("pl"), F.sum("b").alias("pb"),
            F.min("first").alias("first"), F.max("last").alias("last"),
        ).where(_may_split()).select("host", "template", "pn", "pl", "pb")
        key = ["host", "template"]
        if level >= LEVELS:
            open_ = splittable(parents, key).select(*key, F.lit(True).alias("open"))
            rows = stored(rows.join(open_, key, "left"), "levels")
            ends = F.col("open").isNull() | F.col("segment").isNull()
            finished.append(rows.where(ends).drop("open", "segment"))
            rows = rows.where(~ends).drop("open")
            if rows.isEmpty():
                break
        compared = branches.drop("first", "last").join(splittable(parents, key), key).where(
            F.col("n") >= LEAST_PAGES
        )
        rest_l, rest_b = F.col("pl") - F.col("l"), F.col("pb") - F.col("b")
        mean = F.col("pb") / F.col("pl")
        error = F.sqrt(mean * (1 - mean) * (1 / F.col("l") + 1 / rest_l))
        apart = F.abs(F.col("b") / F.col("l") - rest_b / rest_l)
        own = compared.where((F.col("l") > 0) & (rest_l > 0)).where(
            apart > F.lit(DIFFERENT) * error
        )
        key = ["host", "template", "segment"]
        own = own.select(*key, F.lit(True).alias("own"))
        rows = rows.join(splittable(own, key), key, "left").withColumn(
            "template",
            F.when(F.col("segment").isNull(), F.col("template")).otherwise(
                F.concat_ws(
                    "/", "template", F.when(F.col("own"), F.col("segment")).otherwise(F.lit("*"))
                )
            ),
        )
        here = F.lit(True) if level < LEVELS else F.coalesce("own", F.lit(False))
        rows = rows.withColumn(
            "written", F.when(here, F.col("template")).otherwise(F.col("written"))
        )
        if level >= LEVELS:
            rows = rows.withColumn(
                "depth", F.when(here, F.lit(level + 1)).otherwise(F.col("depth"))
            )
        rows = rows.drop("own", "segment")
    deeper = F.size("segments") > F.col("depth")
    return reduce(DataFrame.unionByName, finished).withColumn(
        "template", F.when(deeper, F.concat("written", F.lit("/**"))).otherwise(F.col("written"))
    ).drop("segments", "written", "depth")


def judge(
    pages: DataFrame,
    labels: DataFrame,
    rules: tuple[Rule, ...] = RULES,
    document: Column | None = None,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, bad_share), one row per row of ``pages``.

    The longest fitting rule decides, else the template: block if its smoothed share of bad
    pages is at least 0.5, else allow. Null urls and urls without ``://`` have empty host and
    path and share one template. ``document`` names the document whose labels a page has, by
    columns of ``pages``; without it the number that ends the path does. A page with several
    labels is bad if one of them is; null labels count as good. Without labels the share is 0.
    An empty table gives no rows; other columns are ignored.
    """
    host, path = host_and_path(F.col("url"))
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    marked = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(F.coalesce(bad, F.lit(0))).alias("_bad")
    )
    if document is None:
        document = document_number(path)
    rows = pages.select(
        "page_id", host.alias("host"), path.alias("path"), document.alias("_document")
    )
    rows = rows.join(splittable(marked, ["_id"]), F.col("_document") == F.col("_id"), "left")
    rows = stored(
        rows.select(
            "page_id", "host", "path",
            F.col("_bad").isNotNull().cast("int").alias("labelled"),
            F.coalesce("_bad", F.lit(0)).alias("bad"),
        ),
        "urls",
    )
    placed = stored(templates(rows), "templates")
    found = placed.groupBy("host", "template").agg(
        F.sum("labelled").alias("l"), F.sum("bad").alias("b")
    )
    hosts = found.groupBy("host").agg(F.sum("l").alias("hl"), F.sum("b").alias("hb"))
    everything = rows.agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b")).first()
    prior = (everything.b or 0) / max(1, everything.l or 0)
    shares = found.join(splittable(hosts, ["host"]), "host").select(
        "host", "template",
        _bad_share("b", "l", _bad_share("hb", "hl", F.lit(prior))).alias("bad_share"),
    )
    key = ["host", "template"]
    rule = _longest_rule(rules)
    verdict = F.when(F.col("bad_share") >= REJECT, "block").otherwise("allow")
    by_rule = F.lit(None).cast("string")
    for r in rules:
        by_rule = F.when(F.col("rule") == r.text, r.verdict).otherwise(by_rule)
    return (
        placed.join(splittable(shares, key), key, "left")
        .withColumn("rule", rule)
        .select(
            "page_id", "host", "path", "rule",
            F.coalesce(by_rule, verdict).alias("verdict"),
            "template", "bad_share",
        )
    )
