"""URL filter by a path-template tree, in DataFrame expressions only.

Every url is host and path; a path is a list of segments in which runs of digits and long hexadecimal names are
wildcards already. Per host the tree is walked from the root: a child whose labelled pages are clearly better or worse
than those of all its siblings together stays a branch; the other children become the wildcard ``*`` where there are
many, and are merged into one branch ``~`` where there are few. The labels of a template are
smoothed towards the rate of all labels, and a template whose share of good pages is too low is rejected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from idloom.session import cut

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: segments from this one on are one tail; children from which on a node is wide; standard errors that set a branch
#: apart; weight of the overall rate in a template's own; least share of good pages
LEVELS, WIDE, APART, WEIGHT, PURITY = 6, 20, 3.0, 20.0, 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A to Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    rest = F.coalesce(F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3))), F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(F.substr(rest, F.length(host) + F.lit(1)), "^[^?#]*", 0)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """(rule, verdict) of the longest (host, path, verdict) rule that fits, else null; ties by text."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        best = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def segments(path: Column, levels: int = LEVELS) -> Column:
    """Segments with their digits and hexadecimal names generalised; what is deeper than the levels is one tail."""
    own = F.transform(F.split(F.regexp_replace(path, "^/", ""), "/"), lambda s: F.regexp_replace(
        F.regexp_replace(s, "[0-9a-f]{16,}", "%"), "[0-9]+", "#"))
    return F.when(F.size(own) > levels, F.concat(F.slice(own, 1, levels - 1), F.array(F.lit("**")))).otherwise(own)


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str, str]], page_id: str = "page_id", url: str = "url",
          levels: int = LEVELS, wide: int = WIDE, apart: float = APART, weight: float = WEIGHT, purity: float = PURITY) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for each row of ``pages``.

    ``labels`` has one (page_id, good) row per labelled page, ``good`` 0 or 1; rows with a null are ignored, repeated
    ones count once by their mean. A page without a host has the empty template. Without labels
    everything passes. Repeated pages get a row each and count each. Pages are counted per host and path shape before
    anything is shuffled, so a host with a third of all pages costs as little as any other.
    """
    host, path = host_and_path(F.col("_url"))
    known = labels.filter(labels[page_id].isNotNull() & labels["good"].isNotNull()).groupBy(labels[page_id].alias("_label_id")).agg(
        F.avg("good").alias("_good"))
    parsed = pages.select(pages[page_id].alias("_id"), pages[url].alias("_url")).select(
        "_id", host.alias("host"), path.alias("path")).withColumn("shape", segments(F.col("path"), levels))
    met = parsed.join(known, F.col("_id") == F.col("_label_id"), "left")
    paths = cut(met.groupBy("host", "shape").agg(
        F.count("_good").alias("n"), F.coalesce(F.sum("_good"), F.lit(0.0)).alias("good")))
    total = paths.agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.max(F.size("shape")).alias("depth")).first()
    rate = total["good"] / total["n"] if total["n"] else 1.0
    tree = paths.withColumn("template", F.lit(""))
    for level in range(total["depth"] or 0):
        tree = tree.withColumn("child", F.get("shape", F.lit(level)))
        children = tree.filter("child IS NOT NULL").groupBy("host", "template", "child").agg(
            F.sum("n").alias("c_n"), F.sum("good").alias("c_good"))
        nodes = children.groupBy("host", "template").agg(
            F.sum("c_n").alias("s_n"), F.sum("c_good").alias("s_good"), F.count("*").alias("width"))
        p = F.try_divide("s_good", "s_n")
        off = F.try_divide(F.abs(F.col("c_good") - F.col("c_n") * p), F.sqrt(F.col("c_n") * p * (1 - p)))
        named = children.join(nodes, ["host", "template"]).select(
            "host", "template", "child",
            F.when((F.col("c_n") > 0) & (p > 0) & (p < 1) & (F.col("c_n") < F.col("s_n")) & (off > apart), F.col("child"))
            .when(F.col("width") >= wide, "*").otherwise("~").alias("branch"))
        tree = cut(tree.join(named, ["host", "template", "child"], "left").select(
            "host", "shape", "n", "good", F.when(F.col("branch").isNotNull(), F.concat("template", F.lit("/"), "branch")).otherwise(
                F.col("template")).alias("template")))
    pure = tree.groupBy("host", "template").agg(
        ((F.sum("good") + F.lit(weight * rate)) / (F.sum("n") + F.lit(weight))).alias("purity"))
    judged = tree.select("host", "shape", "template").join(pure, ["host", "template"])
    rule = rule_of(F.col("host"), F.col("path"), rules)
    return parsed.join(judged, ["host", "shape"]).withColumn("_rule", rule).select(
        F.col("_id").alias(page_id), "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("purity") < purity, "block").otherwise("allow")).alias("verdict"),
        "template", "purity")


def judge_sql(pages: str, labels: str, rules: list[tuple[str, str, str]], levels: int = LEVELS, wide: int = WIDE, apart: float = APART,
              weight: float = WEIGHT, purity: float = PURITY) -> str:
    """The same in DuckDB SQL; ``pages`` (page_id, url) and ``labels`` (page_id, good) are queries."""
    ordered = sorted(rules, key=lambda r: (len(r[0] + r[1]), r[0] + r[1]), reverse=True)

    def case(value):
        return "CASE " + " ".join(
            f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{value(h, p, v)}'" for h, p, v in ordered) + " END"

    steps = ["""t0 AS (SELECT host, shape, count(good) AS n, coalesce(sum(good), 0) AS good, '' AS template
        FROM parsed LEFT JOIN known USING (page_id) GROUP BY host, shape)""",
             "rate AS (SELECT coalesce(sum(good) / nullif(sum(n), 0), 1.0) AS rate FROM t0)"]
    for i in range(levels):
        steps += [f"""c{i} AS (SELECT host, template, shape[{i + 1}] AS child, sum(n) AS c_n, sum(good) AS c_good
            FROM t{i} WHERE len(shape) > {i} GROUP BY ALL)""",
                  f"s{i} AS (SELECT host, template, sum(c_n) AS s_n, sum(c_good) AS s_good, count(*) AS width FROM c{i} GROUP BY ALL)",
                  f"""b{i} AS (SELECT host, template, child, CASE WHEN c_n > 0 AND s_good > 0 AND s_good < s_n AND c_n < s_n
            AND abs(c_good - c_n * (s_good / s_n)) / sqrt(c_n * (s_good / s_n) * (1 - s_good / s_n)) > {apart} THEN child
            WHEN width >= {wide} THEN '*' ELSE '~' END AS branch FROM c{i} JOIN s{i} USING (host, template))""",
                  f"""t{i + 1} AS (SELECT t.host, t.shape, t.n, t.good, CASE WHEN branch IS NULL THEN t.template
            ELSE t.template || '/' || branch END AS template
            FROM t{i} t LEFT JOIN b{i} b ON t.host = b.host AND t.template = b.template AND t.shape[{i + 1}] = b.child)"""]
    return f"""WITH rest AS (SELECT page_id, coalesce(CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END, '') AS rest FROM ({pages})),
    hosted AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM rest),
    split AS (SELECT page_id, translate(raw, '{_UPPER}', '{_LOWER}') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM hosted),
    listed AS (SELECT *, list_transform(string_split(regexp_replace(path, '^/', ''), '/'),
        lambda s: regexp_replace(regexp_replace(s, '[0-9a-f]{{16,}}', '%', 'g'), '[0-9]+', '#', 'g')) AS own FROM split),
    parsed AS (SELECT page_id, host, path, CASE WHEN len(own) > {levels} THEN list_append(own[1:{levels - 1}], '**') ELSE own END AS shape FROM listed),
    known AS (SELECT page_id, avg(good) AS good FROM ({labels}) WHERE page_id IS NOT NULL AND good IS NOT NULL GROUP BY page_id),
    {", ".join(steps)},
    pure AS (SELECT host, template, (sum(good) + {weight} * any_value(rate)) / (sum(n) + {weight}) AS purity FROM t{levels}, rate GROUP BY host, template)
    SELECT page_id, host, path, {case(lambda h, p, v: h + p)} AS rule,
        coalesce({case(lambda h, p, v: v)}, CASE WHEN purity < {purity} THEN 'block' ELSE 'allow' END) AS verdict, template, purity
    FROM parsed JOIN t{levels} USING (host, shape) JOIN pure USING (host, template)"""
