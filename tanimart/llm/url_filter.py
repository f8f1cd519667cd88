"""URL filter with redirect equivalence.

Rules (host, path prefix, allow or block) decide a URL directly.  URLs that
are the same page under another address (a redirect, a canonical link, or
only another scheme, fragment or tracking parameter) form an equivalence
class: connected components over those edges, computed by star contraction on
the cluster.  A URL that no rule fits takes its class's decision: allow if
any member is explicitly allowed, else block if any member is blocked, else
the default.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import save
from .components import components

#: Rules up to which a list is held in the plan as an expression; a longer
#: one is joined as a table.
LITERAL_RULES = 10_000


def url_host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or a URL without ``://``."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.when(at > 0, F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise("")


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end (so it starts with ``/`` or is empty)."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    return F.when(at > 0, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def page_key(url: Column) -> Column:
    """Address of a page without scheme, ``www.``, fragment, tracking
    parameters (``utm_*``, ``ref``, ``fbclid``, ``gclid``) and a slash at the end
    of the path; null where there is no host."""
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike("^(utm_[^=]*|ref|fbclid|gclid)(=|$)"))), "&")
    host = F.regexp_replace(url_host(url), r"^www\.", "")
    path = F.regexp_replace(url_path(url), "/+$", "")
    return F.when(host != "", F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value in a tag, entities decoded; empty if it has none."""
    found = rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|["']?([^\s"'>]+))"""
    return decoded(F.concat(*[F.regexp_extract(tag, found, k) for k in (1, 2, 3)]))


def decoded(text: Column) -> Column:
    """``text`` with numeric and HTML 4 entities (and ``&apos;``) replaced, once."""
    names = F.create_map(*[F.lit(x) for n, c in ({"apos": 39} | name2codepoint).items() for x in (n, chr(c))])

    def piece(p: Column, i: Column) -> Column:
        name = F.regexp_extract(p, "^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z0-9]+);", 1)
        code = F.when(name.rlike("^#[xX]"), F.conv(F.substring(name, 3, 6), 16, 10)).when(name.startswith("#"), F.substring(name, 2, 7)).cast("int")
        valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
        char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")).when(code.isNull(), F.try_element_at(names, name))
        return F.when(i == 0, p).when(char.isNotNull(), F.concat(char, F.substring(p, F.length(name) + 2, F.length(p)))).otherwise(F.concat(F.lit("&"), p))

    return F.when(F.instr(text, "&") > 0, F.array_join(F.transform(F.split(text, "&"), piece), "")).otherwise(text)


def resolved(base: Column, to: Column) -> Column:
    """``to`` as an absolute URL, seen from the page ``base``; null where it is
    none (empty, another kind of scheme, or relative to a page without host).

    Dot segments are removed from relative targets; absolute ones stay as they are."""
    to = F.regexp_replace(to, r"^\s+|\s+$", "")
    scheme, origin = F.regexp_extract(base, "^([^:/?#]+)://", 1), F.regexp_extract(base, "^([^:/?#]+://[^/?#]+)", 1)
    path = url_path(base)
    joined = F.when(to.startswith("/"), to).when(to.startswith("?"), F.concat(path, to)).otherwise(
        F.concat(F.when(path == "", F.lit("/")).otherwise(F.regexp_extract(path, "^(.*/)", 1)), to))
    steps = F.split(F.regexp_extract(joined, "^([^?#]*)", 1), "/")
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda out, s: F.when(s == ".", out).when(
        s == "..", F.when(F.size(out) > 1, F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))).otherwise(out)).otherwise(F.concat(out, F.array(s))))
    relative = F.concat(origin, F.array_join(kept, "/"), F.regexp_extract(joined, "^[^?#]*(.*)$", 1))
    return (F.when(to == "", None).when(to.startswith("#"), base).when(to.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), to).when(to.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), None)
            .when(origin == "", None).when(to.startswith("//"), F.concat(scheme, F.lit(":"), to)).otherwise(relative))


def link_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b) page keys joined by the canonical links and meta refreshes of the page.

    Attributes come in any order and quoting, with entities; relative targets
    count from the page's url.  Null urls or html give no edge."""
    html = F.col(html_col)
    tags = lambda name: F.regexp_extract_all(html, F.lit(rf"(?is)<{name}\b[^>]*>"), F.lit(0))
    links = F.filter(tags("link"), lambda t: F.array_contains(F.split(F.lower(attribute(t, "rel")), r"\s+"), "canonical"))
    refreshes = F.filter(tags("meta"), lambda t: F.lower(F.trim(attribute(t, "http-equiv"))) == "refresh")
    # seconds, then the target with or without "url="; broken quotes cut the content short
    target = lambda t: F.coalesce(
        F.nullif(F.regexp_extract(attribute(t, "content"), r"""(?is)^\s*+[\d.]*+\s*+[;,]?+\s*+(?:url\s*+=\s*+)?+["']?+\s*+([^"'\s]+)""", 1), F.lit("")),
        F.nullif(decoded(F.regexp_extract(t, r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)""", 1)), F.lit("")))
    has = html.rlike(r"(?i)canonical|refresh")
    found = pages.where(has).select(
        F.col(url_col).alias("url"), F.explode(F.concat(F.transform(links, lambda t: attribute(t, "href")), F.transform(refreshes, target))).alias("to"))
    found = found.select(page_key(F.col("url")).alias("a"), page_key(resolved(F.col("url"), F.col("to"))).alias("b"))
    return found.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")


def fitting_rule(host: Column, path: Column, rules: list) -> Column:
    """struct(rule, verdict) of the longest rule that fits, or null.

    A rule fits its host and all subdomains where the path starts with the
    rule's.  Of equally long ones allow wins, then the smaller text."""
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    table = F.array(*[
        F.struct(F.lit(-len(h + p)).alias("size"), F.lit(0 if v == "allow" else 1).alias("kind"), F.lit(h).alias("h"), F.lit(p).alias("p"),
                 F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for h, p, v in rules])
    fits = F.filter(table, lambda r: ((host == r["h"]) | host.endswith(F.concat(F.lit("."), r["h"]))) & path.startswith(r["p"]))
    best = F.array_min(fits)
    return F.when(F.size(fits) > 0, F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def suffixes(host: Column) -> Column:
    """The host and the hosts above it: what is left after each dot."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))


def fitting_table(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, fit) of the different (host, path) of ``urls`` that a row of
    ``rules`` (host, path, verdict) fits, as ``fitting_rule`` decides.

    A host's suffixes meet the lengths that the paths of a rule host have, and
    the path cut to each length meets the rules by equality, so a URL makes at
    most suffixes x lengths rows whatever the number of rules.  A rule with a
    null host or path fits nothing; of repeated rules allow wins."""
    kind = F.when(F.col("verdict") == "allow", 0).otherwise(1)
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL").groupBy(F.col("host").alias("h"), F.col("path").alias("p")).agg(
        F.min(F.struct(kind.alias("kind"), F.col("verdict"))).alias("v"))
    rules = save(rules.select("h", "p", "v.kind", "v.verdict"), "url-rules")
    lengths = rules.groupBy("h").agg(F.collect_set(F.length("p")).alias("lengths"))
    hosts = urls.select("host").distinct().select("host", F.explode(suffixes(F.col("host"))).alias("h")).join(lengths, "h")
    cut = urls.select("host", "path").distinct().join(hosts, "host").select("host", "path", "h", F.explode("lengths").alias("n"))
    cut = cut.where(F.col("n") <= F.length("path")).withColumn("p", F.substring(F.col("path"), F.lit(1), F.col("n")))
    size = (-F.length(F.concat("h", "p"))).alias("size")
    best = cut.join(rules, ["h", "p"]).groupBy("host", "path").agg(F.min(F.struct(size, "kind", "h", "p", "verdict")).alias("b"))
    return best.select("host", "path", F.struct(F.concat("b.h", "b.p").alias("rule"), F.col("b.verdict").alias("verdict")).alias("fit"))


def judge(pages: DataFrame, rules: list | DataFrame, redirects: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url",
          html_col: str | None = "html", default: str = "allow") -> DataFrame:
    """Return (id, host, path, rule, verdict, alias_class) per page.

    ``rules``: (host, path, "allow" | "block") as a list or, in any number, a
    table of columns host, path, verdict.  ``redirects``: optional
    (src, dst) URLs besides the links found in the pages; a relative dst counts
    from src.  A null or odd url
    has empty host and path, fits no rule and gets the default; repeated rows
    are judged alike and each returned; an empty table gives no rows.  Hot
    classes are never gathered: a class's decision is a min per component,
    combined before the shuffle.
    """
    url = F.col(url_col)
    judged = pages.select(
        F.col(id_col).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"), page_key(url).alias("node"))
    if isinstance(rules, list) and len(rules) > LITERAL_RULES:
        rules = save(pages.sparkSession.createDataFrame(rules, "host string, path string, verdict string"), "url-rule-list")
    if isinstance(rules, list):
        judged = judged.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    else:
        judged = judged.join(fitting_table(judged, rules), ["host", "path"], "left")
    judged = save(judged.select("page_id", "host", "path", "node", "fit.rule", F.col("fit.verdict").alias("own")), "url-judged")
    edges = [] if html_col is None else [link_edges(pages, url_col, html_col)]
    if redirects is not None:
        edges.append(redirects.select(page_key(F.col("src")).alias("a"), page_key(resolved(F.col("src"), F.col("dst"))).alias("b")))
    votes = judged.where("node IS NOT NULL AND own IS NOT NULL").groupBy("node").agg(F.min("own").alias("own"))  # allow < block
    classes = None
    if edges:
        linked = edges[0]
        for e in edges[1:]:
            linked = linked.union(e)
        linked = save(linked.distinct(), "url-edges")
        classes = components(linked, "a", "b")
        votes = votes.join(classes, "node", "left").groupBy(F.coalesce("component", "node").alias("component")).agg(F.min("own").alias("own"))
        judged = judged.join(classes, "node", "left").withColumn("component", F.coalesce("component", "node"))
    else:
        votes, judged = votes.withColumnRenamed("node", "component"), judged.withColumn("component", F.col("node"))
    votes = votes.withColumnRenamed("own", "shared")
    return judged.join(votes, "component", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("own", "shared", F.lit(default)).alias("verdict"), F.col("component").alias("alias_class"))
