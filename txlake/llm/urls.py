"""URL filter: fixed rules, and a tree of path templates for what they leave open."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txlake.llm.common import UPPER, staged

# Fixed values: (verdict, host, path) of the rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# A branch keeps its own name when it holds this part of its node's pages ...
BRANCH_SHARE = 0.02
# ... and its rate of blocked pages differs from that of the rest by so many deviations.
BRANCH_SIGMAS = 2.0
# Weight, in labelled pages, that a prior has.
PRIOR_WEIGHT = 4.0
PRIOR = 0.5
BLOCK_FROM = 0.5
WILD, END = "*", ""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without a ``://``."""
    place = F.instr(url, "://")
    after = F.when(place > 0, F.substring(url, place + 3, F.char_length(url))).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as (text like ``net/es/``, verdict); nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, of, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == of) | host.endswith(f".{of}")) & path.startswith(start)
        rule = F.when(fits, F.lit(of + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _smoothed(blocked: Column, labelled: Column, prior: Column) -> Column:
    return (blocked + F.lit(PRIOR_WEIGHT) * prior) / (labelled + F.lit(PRIOR_WEIGHT))


def _rate(blocked: Column, pages: Column) -> tuple[Column, Column]:
    """Mean and variance of a share, one page of either kind added."""
    mean = (blocked + 1) / (pages + 2)
    return mean, mean * (1 - mean) / (pages + 3)


def _branch_names(path: Column) -> Column:
    """Branches that a path takes: its segments, variable ones (with digits) as the wildcard.

    Segments that look like a wildcard or a group of branches are told from them by ``=``.
    """
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    named = lambda s: F.when(s.rlike(r"^[*={]"), F.concat(F.lit("="), s)).otherwise(s)
    return F.transform(segments, lambda s: F.when(s.rlike("[0-9]"), F.lit(WILD)).otherwise(named(s)))


def _group_name(names: Column) -> Column:
    """One branch's own name, or the names of several that are alike as ``{a|b}``."""
    escaped = F.transform(F.array_sort(names), lambda s: F.replace(F.replace(s, F.lit("="), F.lit("==")), F.lit("|"), F.lit("=|")))
    return F.when(F.size(names) == 1, names[0]).otherwise(F.concat(F.lit("{"), F.array_join(escaped, "|"), F.lit("}")))


def _chains(level: DataFrame, elsewhere: DataFrame) -> DataFrame:
    """Walk every node to the next place where its paths part, or where all of them end.

    As long as all paths of a node go on with the same branch there is nothing to compare:
    the branch merges into the wildcard and moves the priors. The common beginning of
    many lists is that of the least and the greatest one, so one aggregation gives the
    length of the chain, and the branches of all chains meet their labels in one join.
    """
    rest = F.slice("names", F.col("depth") + 1, F.size("names"))
    nodes = level.groupBy("host", "template").agg(
        F.min(rest).alias("least"), F.max(rest).alias("greatest"), F.max("depth").alias("at"), F.sum("labelled").alias("c_labelled"), F.sum("blocked").alias("c_blocked")
    )
    same = F.zip_with("least", "greatest", lambda x, y: F.coalesce(x == y, F.lit(False)))
    parted = F.array_position(same, False)
    steps = F.when(parted > 0, parted - 1).otherwise(F.size("least")).cast("int")
    chains = staged(nodes.withColumn("steps", steps).filter("steps > 0").withColumn("common", F.slice("least", 1, F.col("steps"))), "url_chains")
    found = (
        chains.select("host", "template", "at", "c_labelled", "c_blocked", F.posexplode("common").alias("pos", "branch"))
        .withColumn("depth", F.col("at") + F.col("pos"))
        .join(elsewhere, ["depth", "branch"])
        .select("host", "template", "pos", (F.col("s_labelled") - F.col("c_labelled")).alias("others"), (F.col("s_blocked") - F.col("c_blocked")).alias("bad"))
        .groupBy("host", "template")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "others", "bad"))).alias("evidence"))
    )
    moves = chains.select("host", "template", "steps").join(found, ["host", "template"], "left")
    moved = F.aggregate(
        F.coalesce("evidence", F.array().cast("array<struct<pos:int,others:bigint,bad:bigint>>")),
        F.col("prior"),
        lambda prior, e: _smoothed(e["bad"], e["others"], prior),
    )
    walked = level.join(moves, ["host", "template"], "left").withColumn("steps", F.coalesce("steps", F.lit(0)))
    return walked.withColumns(
        {
            "prior": moved,
            "depth": F.col("depth") + F.col("steps"),
            "template": F.concat("template", F.repeat(F.lit(f"/{WILD}"), F.col("steps"))),
        }
    ).drop("steps", "evidence")


def templates(paths: DataFrame) -> DataFrame:
    """The leaf of each (host, path) in its host's template tree: template and impurity.

    ``paths`` has host, path, pages, labelled and blocked counts. From the root of a host
    down, the segments of a node's paths, and the paths that end there, are its branches.
    Segments with digits are variable, and become a wildcard at once. Each path carries a
    prior, one half at the root, which every segment moves by the labels that it has at
    that depth elsewhere, on all hosts; each unlabelled page counts as blocked by its
    prior. A branch stands out if it is common, has labels here or elsewhere, and its rate
    of blocked pages differs from that of the rest of its node; so a branch of blocked
    pages stands out beside unlabelled ones. The others are merged into the wildcard, and
    those that stand out with those whose rates are alike: in the order of their rates, a
    branch joins the one before unless the two differ. At most 50 can stand out in a node.

    The impurity of a path is the share of blocked pages among the labels of its template,
    smoothed towards the path's own prior: where the template has no labels, what its own
    segments say decides, down to the last one, and not what its neighbours are.
    Nodes are walked to their ends however deep; the rounds of jobs are as many as places
    where paths of one node part on the way down, and not as there are segments.
    """
    rows = paths.select("host", "path", "pages", "labelled", "blocked", _branch_names(F.col("path")).alias("names"))
    level = staged(rows.withColumns({"template": F.lit(""), "prior": F.lit(PRIOR), "depth": F.lit(0)}), "url_hosts")
    elsewhere = staged(
        level.filter("labelled > 0")
        .select(F.posexplode("names").alias("depth", "branch"), "labelled", "blocked")
        .filter(F.col("branch") != WILD)
        .groupBy("depth", "branch")
        .agg(F.sum("labelled").alias("s_labelled"), F.sum("blocked").alias("s_blocked")),
        "segment_labels",
    )
    node, done = ["host", "template"], []
    while True:
        level = _chains(level, elsewhere)
        ends = F.size("names") <= F.col("depth")
        branch = F.when(ends, F.lit(END)).otherwise(F.try_element_at("names", F.col("depth") + 1))
        level = staged(level.withColumns({"ends": ends, "branch": branch}), "url_level")
        own = level.groupBy(*node, "depth", "branch").agg(
            *[F.sum(c).alias(f"b_{c}") for c in ("pages", "labelled", "blocked")],
            F.sum((F.col("pages") - F.col("labelled")) * F.col("prior")).alias("b_open"),
        )
        own = own.join(elsewhere, ["depth", "branch"], "left")
        others = F.coalesce(F.col("s_labelled") - F.col("b_labelled"), F.lit(0))
        bad = F.coalesce(F.col("s_blocked") - F.col("b_blocked"), F.lit(0))
        own = own.withColumns({"others": others, "bad": bad})
        # Blocked pages to be expected, of the branch: its priors are moved, then added.
        unlabelled = F.col("b_pages") - F.col("b_labelled")
        expected = F.col("b_blocked") + (F.col("bad") * unlabelled + F.lit(PRIOR_WEIGHT) * F.col("b_open")) / (F.col("others") + F.lit(PRIOR_WEIGHT))
        own = staged(own.withColumn("expected", expected).drop("s_labelled", "s_blocked", "b_open"), "branches")
        nodes = own.groupBy(*node).agg(F.sum("b_pages").alias("n_pages"), F.sum("expected").alias("n_expected"))
        rate, spread = _rate(F.col("expected"), F.col("b_pages"))
        rest, rest_spread = _rate(F.col("n_expected") - F.col("expected"), F.col("n_pages") - F.col("b_pages"))
        apart = (
            (F.col("branch") != WILD)
            & (F.col("b_pages") >= F.lit(BRANCH_SHARE) * F.col("n_pages"))
            & (F.col("b_labelled") + F.col("others") > 0)
            & (F.col("b_pages") < F.col("n_pages"))
            & (F.abs(rate - rest) >= F.lit(BRANCH_SIGMAS) * F.sqrt(spread + rest_spread))
        )
        kept = own.join(nodes, node).filter(apart).select(*node, "branch", rate.alias("rate"), spread.alias("spread"))
        # At most 1 / BRANCH_SHARE rows to a node.
        by_rate = Window.partitionBy(*node).orderBy("rate", "branch")
        differs = F.col("rate") - F.lag("rate").over(by_rate) >= F.lit(BRANCH_SIGMAS) * F.sqrt(F.col("spread") + F.lag("spread").over(by_rate))
        kept = kept.withColumn("differs", F.coalesce(differs, F.lit(False)).cast("int")).withColumn("cluster", F.sum("differs").over(by_rate))
        alike = kept.groupBy(*node, "cluster").agg(F.collect_list("branch").alias("members"))
        child = alike.select(*node, F.explode("members").alias("branch"), _group_name(F.col("members")).alias("child"))
        judged_ = own.select(*node, "branch", "others", "bad").join(child, [*node, "branch"], "left")
        level = level.join(judged_.withColumn("child", F.coalesce("child", F.lit(WILD))), [*node, "branch"])
        level = staged(level.withColumn("prior", _smoothed(F.col("bad"), F.col("others"), F.col("prior"))).drop("others", "bad", "branch"), "url_branches")
        labels = level.groupBy(*node, "child").agg(F.sum("labelled").alias("n_labelled"), F.sum("blocked").alias("n_blocked"))
        impurity = _smoothed(F.col("n_blocked"), F.col("n_labelled"), F.col("prior"))
        last = level.filter("ends").join(labels, [*node, "child"])
        done.append(staged(last.select("host", "path", "template", impurity.alias("impurity")), "url_leaves"))
        level = level.filter("not ends").withColumns(
            {"template": F.concat("template", F.lit("/"), "child"), "depth": F.col("depth") + 1}
        )
        level = level.drop("ends", "child")
        if level.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def judged(pages: DataFrame, page_id: str = "page_id", url: str = "url", rules=RULES) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, template and impurity.

    The longest rule that fits a page decides. Its verdicts label the template tree of
    the page's host, and the segments of all hosts; this decides for the pages without
    a rule: a page whose smoothed share of blocked labels is one half or more is rejected.
    Null urls and urls without ``://`` have an empty host and path and share one template.
    Repeated rows are judged alike; without any rule that fits, impurities are the prior,
    one half, and pages are blocked. Very long urls are read to their end. Further columns
    are not read, whatever their names. An empty table gives no rows.
    """
    host, path = host_and_path(F.col(url))
    named = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    named = staged(named.withColumn("rule", rule).withColumn("label", verdict), "pages")
    paths = named.groupBy("host", "path").agg(
        F.count("*").alias("pages"),
        F.count("label").alias("labelled"),
        F.count(F.when(F.col("label") == "block", 1)).alias("blocked"),
    )
    found = templates(staged(paths, "paths"))
    by_method = F.when(F.col("impurity") >= F.lit(BLOCK_FROM), "block").otherwise("allow")
    return named.join(found, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.coalesce("label", by_method).alias("verdict"), "template", "impurity"
    )
