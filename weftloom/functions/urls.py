"""URL expressions, JVM-side only.

Plain regular expressions rather than ``parse_url``: the latter answers NULL for characters that
are common in crawled links.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from weftloom.params import IMAGE_URL_PATTERN, SKIPPED_HREF_PREFIXES

SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.\-]*):"
HOST = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)"
PATH = r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, SCHEME, 1))


def host(url: Column) -> Column:
    """Host with port and user, in the case it was written."""
    return F.regexp_extract(url, HOST, 1)


def origin(url: Column) -> Column:
    return F.concat(scheme(url), F.lit("://"), host(url))


def raw_path(url: Column) -> Column:
    return F.regexp_extract(url, PATH, 1)


def path(url: Column) -> Column:
    """Path without the ``;parameters`` of its last segment."""
    return F.regexp_replace(raw_path(url), r";[^/]*$", "")


def base_name(url: Column) -> Column:
    """Last segment of the path; a trailing slash does not count."""
    return F.element_at(F.split(F.rtrim(path(url), F.lit("/")), "/"), -1)


def normalize(url: Column) -> Column:
    """Scheme, host and path; no trailing slash except on the root, no parameters, query or fragment."""
    trimmed = F.rtrim(path(url), F.lit("/"))
    return F.concat(origin(url), F.when(trimmed == "", F.lit("/")).otherwise(trimmed))


def navigates(href: Column) -> Column:
    """Neither a script, mail, phone or data link nor a bare fragment; compared as written."""
    skipped = F.lit(False)
    for prefix in SKIPPED_HREF_PREFIXES:
        skipped = skipped | F.startswith(href, F.lit(prefix))
    return ~skipped


def is_web(url: Column) -> Column:
    return scheme(url).isin("http", "https")


def _without_dots(absolute_path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments of a path that starts with a slash.

    The empty segment before that slash can be stepped out of like any other; the slash comes back in the end.
    """
    segments = F.split(absolute_path, "/", -1)
    kept = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(s))),
    )
    ends_in_folder = F.element_at(segments, -1).isin(".", "..")
    joined = F.array_join(F.when(ends_in_folder, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")
    rooted = F.when(F.startswith(joined, F.lit("/")), joined).otherwise(F.concat(F.lit("/"), joined))
    plain = ~absolute_path.rlike(r"(^|/)\.\.?(/|$)")
    return F.when(plain, absolute_path).otherwise(rooted)


def resolve(base: Column, reference: Column) -> Column:
    """``reference`` as seen from the absolute URL ``base``; a full URL keeps its path as written."""
    as_written = reference
    reference = F.regexp_replace(reference, r"[\t\r\n]", "")
    same_scheme = scheme(reference) == scheme(base)
    reference = F.when(same_scheme, F.regexp_replace(reference, r"^[^:]*:(?!//)", "")).otherwise(reference)
    path_of = raw_path(reference)
    # an empty query or fragment leaves no mark
    tail = F.regexp_replace(F.regexp_extract(reference, r"^[^?#]*(.*)$", 1), r"\?(?=#|$)|#$", "")
    base_path = raw_path(base)
    folder = F.regexp_extract(base_path, r"^(.*/)[^/]*$", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    base_query = F.regexp_extract(base, r"^[^?#]*(\?[^#]*)", 1)
    joined = F.regexp_replace(F.concat(folder, path_of), r"/{2,}", "/")
    return (
        F.when(reference == "", base)
        .when(
            reference.rlike(SCHEME),
            F.when(same_scheme, F.concat(origin(reference), path_of, tail)).otherwise(as_written),
        )
        .when(F.startswith(reference, F.lit("//")), F.concat(scheme(base), F.lit("://"), host(reference), path_of, tail))
        .when(F.startswith(reference, F.lit("?")), F.concat(origin(base), base_path, tail))
        .when(F.startswith(reference, F.lit("#")), F.concat(origin(base), base_path, base_query, tail))
        .when(F.startswith(reference, F.lit("/")), F.concat(origin(base), _without_dots(path_of), tail))
        .otherwise(F.concat(origin(base), _without_dots(joined), tail))
    )


def srcset_urls(srcset: Column) -> Column:
    """First token of every comma-separated candidate. URLs that contain a comma break, as documented."""
    tokens = F.transform(F.split(srcset, ","), lambda part: F.regexp_extract(part, r"^\s*(\S*)", 1))
    return F.filter(tokens, lambda token: token != "")


def is_image(url: Column) -> Column:
    return url.rlike(IMAGE_URL_PATTERN)


def target_name(url: Column) -> Column:
    """File name an image is stored under: base name of the path, or one made from the URL's hash."""
    name = base_name(url)
    made = F.format_string("img_%08d.jpg", F.pmod(F.xxhash64(url), F.lit(100_000_000)))
    return F.when((name == "") | ~F.contains(name, F.lit(".")), made).otherwise(name)
