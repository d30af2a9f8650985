"""Sites, robots rules, reachability and URL pools."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from weftloom.functions import urls
from weftloom.operators.ordering import number_rows, running_max
from weftloom.operators.skew import skew_join
from weftloom.session import broadcast_if_small, materialize, scratch_path

SMALL_FRONTIER = 10_000
SMALL_FRONTIER_HOPS = 2


def internal_links(links: DataFrame, seeds: DataFrame) -> DataFrame:
    """Links whose host, port included, is the host of a seed."""
    hosts = broadcast_if_small(seeds.select(urls.host(F.col("url")).alias("_host")).distinct())
    return links.withColumn("_host", urls.host(F.col("link"))).join(hosts, "_host", "left_semi").drop("_host")


def robots_allowed(targets: DataFrame, robots: DataFrame) -> DataFrame:
    """Add ``allowed`` to ``targets(url)``.

    ``robots(host, policy, pos, allow, prefix, crawl_delay)`` has the rules for all agents; the first
    one in file order whose prefix starts the path and query decides, and without one the URL is
    allowed. Hosts with policy allow_all, deny_all or unread are answered as a whole, and
    hosts without rules allow.

    Rules stay rows. A URL is cut to each length that a prefix of its host has, and these beginnings are looked up by
    equality, so that a long rule file costs a URL no more than it has different lengths.
    """
    local = F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*([^#]*)", 1)
    asked = materialize(
        targets.select("url").distinct().withColumn("host", urls.host(F.col("url"))).withColumn(
            "local", F.when(F.startswith(local, F.lit("/")), local).otherwise(F.concat(F.lit("/"), local))
        )
    )
    # an empty Disallow forbids nothing
    rules = robots.where("policy = 'rules' and prefix is not null and (allow or prefix <> '')")
    first = rules.groupBy("host", "prefix").agg(F.min("pos").alias("pos"), F.min_by("allow", "pos").alias("allow"))
    sizes = rules.select("host", F.length("prefix").alias("size")).distinct()
    beginnings = asked.join(broadcast_if_small(sizes), "host").where("size <= length(local)").select(
        "url", "host", F.expr("substring(local, 1, size)").alias("prefix")
    )
    decided = skew_join(materialize(beginnings), first, ["host", "prefix"]).groupBy("url").agg(F.min_by("allow", "pos").alias("allow"))
    policies = robots.groupBy("host").agg(F.max("policy").alias("policy"))
    verdict = (
        F.when(F.col("policy").isin("deny_all", "unread"), F.lit(False))
        .when(F.col("policy") == "allow_all", F.lit(True))
        .otherwise(F.coalesce("allow", F.lit(True)))
    )
    answers = asked.join(broadcast_if_small(policies), "host", "left").join(decided, "url", "left").select("url", verdict.alias("allowed"))
    return skew_join(targets, answers, ["url"], "left").select(*targets.columns, "allowed")


def crawl_delays(targets: DataFrame, robots: DataFrame) -> DataFrame:
    """Add ``delay``, ``crawl_wait`` (at least 1 s) and ``scrape_wait`` (at least 0.5 s).

    A delay that is missing or 0, as with unread rules, counts as 1 second.
    """
    known = F.when(F.col("policy") == "rules", F.col("crawl_delay"))
    per_host = robots.groupBy("host").agg(F.max(known).alias("_delay"))
    delay = F.coalesce(F.nullif(F.col("_delay"), F.lit(0.0)), F.lit(1.0))
    joined = targets.withColumn("host", urls.host(F.col("url"))).join(broadcast_if_small(per_host), "host", "left")
    return joined.select(
        *targets.columns,
        delay.alias("delay"),
        F.greatest(delay, F.lit(1.0)).alias("crawl_wait"),
        F.greatest(delay, F.lit(0.5)).alias("scrape_wait"),
    )


def expandable(pages: DataFrame) -> DataFrame:
    """Pages whose links are followed: answered as HTML. Others count as visited only."""
    return pages.where(F.contains(F.coalesce("content_type", F.lit("")), F.lit("text/html")))


def crawl_reachable(
    seeds: DataFrame,
    links: DataFrame,
    closed: DataFrame | None = None,
    sites: DataFrame | None = None,
) -> DataFrame:
    """URLs reachable from ``seeds(url)`` over ``links(url, link)``: ``(url, depth)``.

    ``closed(url)`` are URLs that are visited but not expanded (disallowed, failed or not
    HTML). The crawl goes on until nothing new is found. With a column ``crawl`` in ``seeds``, each of its values is a crawl of its own and
    comes first in the result; all of them advance together, so that the rounds are those of the deepest. ``sites(host)``, or
    ``sites(crawl, host)``, limits a crawl to its hosts.

    Every round appends to one table of visited URLs, so that plans stay the same size however deep the
    site is. A large frontier advances by one depth a round, a small one by several, as a
    round then costs more than the rows in it.
    """
    spark = seeds.sparkSession
    table = scratch_path(spark)
    crawl = [name for name in seeds.columns if name == "crawl"]
    key = [*crawl, "url"]
    open_links = links.select("url", "link").distinct()
    if closed is not None:
        open_links = open_links.join(closed.select("url"), "url", "left_anti")
    open_links = materialize(open_links.withColumn("host", urls.host(F.col("link"))))
    if sites is not None:
        sites = broadcast_if_small(materialize(sites.select(*crawl, "host").distinct()))

    seeds.select(*key).distinct().withColumn("depth", F.lit(0)).write.parquet(f"{table}/round=0")
    schema = "".join(f"{name} {seeds.schema[name].dataType.simpleString()}, " for name in key) + "depth int"
    read = lambda path: spark.read.schema(schema).parquet(path)
    depth, rounds = 0, 0
    frontier_size = read(f"{table}/round=0").count()
    while frontier_size:
        hops = 1 if frontier_size > SMALL_FRONTIER else SMALL_FRONTIER_HOPS
        visited = read(table)
        step = read(f"{table}/round={rounds}").where(F.col("depth") == depth).select(*key)
        found = None
        for hop in range(1, hops + 1):
            step = open_links.join(step, "url").select(*crawl, "host", F.col("link").alias("url"))
            if sites is not None:
                step = step.join(sites, [*crawl, "host"], "left_semi")
            step = step.select(*key).distinct().join(visited.select(*key), key, "left_anti")
            reached = step.withColumn("depth", F.lit(depth + hop))
            found = reached if found is None else found.unionByName(reached)
        new = found.groupBy(*key).agg(F.min("depth").alias("depth")).join(visited.select(*key), key, "left_anti")
        rounds, depth = rounds + 1, depth + hops
        new.write.parquet(f"{table}/round={rounds}")
        written = read(f"{table}/round={rounds}")
        frontier_size = written.where(F.col("depth") == depth).count()
    return read(table)


def keyword_url_pool(keywords: DataFrame, seeds: DataFrame, own: DataFrame, shared: DataFrame) -> DataFrame:
    """URLs to score per keyword: its own crawl if it has seeds, otherwise the shared crawl.

    ``seeds(keyword, url)`` with NULL keyword for shared seeds; ``own(keyword, url)``; ``shared(url)``.
    """
    seeded = seeds.where("keyword is not null").select("keyword").distinct()
    mine = own.join(seeded, "keyword", "left_semi").join(keywords, "keyword", "left_semi").select("keyword", "url")
    # the others each get the whole shared crawl, spelt out row by row; their names travel as one row
    others = keywords.select("keyword").join(seeded, "keyword", "left_anti")
    names = others.agg(F.collect_set("keyword").alias("names"))
    return mine.unionByName(shared.join(F.broadcast(names)).select(F.explode("names").alias("keyword"), "url"))


def cached_override(cached: DataFrame, scored: DataFrame, cached_keywords: DataFrame) -> DataFrame:
    """Relevant URLs: a keyword with a cached list, even an empty one, uses only that."""
    fresh = scored.join(cached_keywords.select("keyword"), "keyword", "left_anti")
    return cached.select("keyword", "url", "rank").unionByName(fresh.select("keyword", "url", "rank"))


def accepted_downloads(downloads: DataFrame, min_dim: int = 500) -> DataFrame:
    """Answered with 200 and at least ``min_dim`` wide and high; undecodable images have size -1."""
    return downloads.where(f"status = 200 and width >= {min_dim} and height >= {min_dim}")


def collision_names(images: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Add ``stored_name`` to ``images(keyword, pos, name)``: ``stem.ext``, ``stem_1.ext``, ``stem_2.ext`` ….

    In order of ``pos`` each image takes the first form of its name that is free. Names in
    ``stored(keyword, name)``, those of earlier runs, are taken before the first image. Equal names are
    numbered at once, past stored forms; a further round is only needed where a numbered name is also somebody's
    genuine name, and then only for the names involved.
    """
    taken = None if stored is None else materialize(_taken_forms(images, stored))
    numbered = number_rows(images.select("keyword", "pos", "name"), ["keyword", "name"], [F.col("pos")], "turn")
    claims = materialize(numbered.withColumn("skipped", F.lit(0)))
    while True:
        placed = claims.withColumn("form", F.col("turn") - 1 + F.col("skipped"))
        placed = placed if taken is None else materialize(_past_taken(placed, taken))
        named = placed.withColumn("stored_name", _numbered_name(F.col("name"), F.col("form")))
        # the earliest claim of a name wins; the losers move on by one form
        first = named.groupBy("keyword", "stored_name").agg(F.min("pos").alias("winner"), F.count("*").alias("claims"))
        contested = first.where("claims > 1").drop("claims")
        losers = materialize(named.join(contested, ["keyword", "stored_name"]).where("pos > winner").select("keyword", "pos", "name"))
        if losers.isEmpty():
            return images.join(named.select("keyword", "pos", "stored_name"), ["keyword", "pos"])
        families = losers.select("keyword", "name").distinct()
        calm = claims.join(families, ["keyword", "name"], "left_anti")
        moved = claims.join(families, ["keyword", "name"], "left_semi").join(
            losers.withColumn("lost", F.lit(1)), ["keyword", "pos", "name"], "left"
        ).withColumn("want", F.col("skipped") + F.coalesce("lost", F.lit(0)))
        # later images of the same name stay behind earlier ones
        pushed = running_max(moved, ["keyword", "name"], "turn", "want", "pushed").select(
            "keyword", "pos", "name", "turn", F.col("pushed").alias("skipped")
        )
        claims = materialize(calm.select("keyword", "pos", "name", "turn", "skipped").unionByName(pushed))


def _taken_forms(images: DataFrame, stored: DataFrame) -> DataFrame:
    """``(keyword, name, form)``: the numbers of the forms of the images' names that are stored, with ``form`` less the taken ones below it.

    A form is free at ordinal ``n`` if it has ``n`` free forms below; that many taken forms come before it as have a difference up to ``n``.
    """
    given = stored.select("keyword", "name").distinct()
    numbered = r"^(.*)_([1-9][0-9]{0,17})(\.[^.]*)$"
    own = given.withColumn("form", F.lit(0).cast("long"))
    others = given.where(F.col("name").rlike(numbered)).select(
        "keyword",
        F.concat(F.regexp_extract("name", numbered, 1), F.regexp_extract("name", numbered, 3)).alias("name"),
        F.regexp_extract("name", numbered, 2).cast("long").alias("form"),
    )
    wanted = images.select("keyword", "name").distinct()
    forms = own.unionByName(others).join(wanted, ["keyword", "name"], "left_semi")
    ordered = number_rows(forms, ["keyword", "name"], [F.col("form")], "nth")
    return ordered.select("keyword", "name", (F.col("form") - F.col("nth") + 1).alias("form"))


def _past_taken(claims: DataFrame, taken: DataFrame) -> DataFrame:
    """``claims`` with ``form`` turned from an ordinal among the free forms of a name into the form itself."""
    # a claim's number among taken forms and claims, less its turn among the claims alone, is how many taken forms come before
    both = claims.withColumn("_claim", F.lit(1)).unionByName(taken.withColumn("_claim", F.lit(0)), allowMissingColumns=True)
    counted = number_rows(both, ["keyword", "name"], [F.col("form"), F.col("_claim")], "nth").where("_claim = 1")
    return counted.withColumn("form", F.col("form") + F.col("nth") - F.col("turn")).drop("_claim", "nth")


def _numbered_name(name, number):
    stem = F.regexp_extract(name, r"^(.*)\.([^.]*)$", 1)
    ending = F.regexp_extract(name, r"^(.*)\.([^.]*)$", 2)
    return F.when(number == 0, name).otherwise(F.concat(stem, F.lit("_"), number, F.lit("."), ending))
