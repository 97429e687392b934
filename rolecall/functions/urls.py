"""URL expressions. Split with substring functions and one short regex each; all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rolecall.functions import constants as K
from rolecall.functions.stage import settled
from rolecall.functions.text import blank_to_null

_SCHEME = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"


def _tidy(url: Column) -> Column:
    """Drop leading control characters and blanks, and tabs or line breaks anywhere."""
    return F.translate(F.regexp_replace(url, r"^[\x00-\x20]+", ""), "\t\r\n", "")


def _before_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def _query(url: Column) -> Column:
    base = _before_fragment(url)
    return F.substr(base, F.length(F.substring_index(base, "?", 1)) + 2)


def _decode(c: Column) -> Column:
    """Percent-decode a form value; a ``%`` that starts no escape stays as it is."""
    return F.try_url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encode(c: Column) -> Column:
    """Form-encode, leaving ``~`` bare and escaping ``*``."""
    return F.replace(
        F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
    )


def query_items(query: Column) -> Column:
    """Decoded (k, v) pairs in order; items without a value are dropped."""
    pairs = F.filter(F.split(query, "&"), lambda p: p.rlike("(?s)=."))
    return F.transform(
        pairs,
        lambda p: F.struct(
            _decode(F.substring_index(p, "=", 1)).alias("k"),
            _decode(F.substr(p, F.length(F.substring_index(p, "=", 1)) + 2)).alias("v"),
        ),
    )


def _clean_query(items: Column) -> Column:
    """Query string of the first value per parameter that is not a tracking one."""
    first = F.filter(
        items,
        lambda x, i: ~x["k"].isin(K.TRACKING_PARAMS)
        & (F.array_position(F.transform(items, lambda y: y["k"]), x["k"]) == i + 1),
    )
    return F.array_join(
        F.transform(first, lambda x: F.concat(_encode(x["k"]), F.lit("="), _encode(x["v"]))), "&"
    )


def with_canonical_url(df: DataFrame, url: str, out: str) -> DataFrame:
    """https, no application-form tail, no tracking parameters, first value per parameter.

    Staged, so that each part of the URL is worked out once.
    """
    u, base, target, authority = (F.col(c) for c in ("_u", "_base", "_target", "_authority"))
    path, query = F.col("_path"), F.col("_query")
    split = (
        df.withColumn("_u", _tidy(F.col(url)))
        .withColumn("_base", _before_fragment(u))
        .withColumn("_fragment", F.substr(u, F.length(base) + 1))
        .withColumn("_located", F.substring_index(base, "?", 1))
        .withColumn("_query", F.substr(base, F.length("_located") + 2))
        .withColumn("_target", F.regexp_replace("_located", _SCHEME, ""))
        .withColumn("_authority", F.regexp_extract(target, r"^//([^/]*)", 1))
        .withColumn(
            "_path",
            F.when(target.startswith("//"), F.substr(target, F.length(authority) + 3)).otherwise(target),
        )
        # the tail may stand before ;parameters of the last segment; a lone trailing ';' is empty
        .withColumn("_path", F.regexp_replace(path, r"/apply/?(;[^/]*)?\z", "$1"))
        .withColumn("_path", F.regexp_replace(path, r"(^|/)([^/;]*);\z", "$1$2"))
        .withColumn("_items", F.when(query != "", query_items(query)))
        .withColumn("_query", F.when(query != "", _clean_query(F.col("_items"))))
    )
    whole = F.concat(
        F.lit("https:"),
        F.when((authority != "") | (path == "") | path.startswith("/"), F.lit("//")).otherwise(""),
        authority,
        path,
        F.when(F.coalesce(query, F.lit("")) == "", "").otherwise(F.concat(F.lit("?"), query)),
        F.when(F.col("_fragment") == "#", "").otherwise(F.col("_fragment")),
    )
    parts = ["_u", "_base", "_fragment", "_located", "_query", "_target", "_authority", "_path", "_items"]
    return settled(split.withColumn(out, whole).drop(*parts), out)


def host(url: Column) -> Column:
    """Lower-case host name without user info and port; '' when the URL has none."""
    netloc = F.substring_index(F.regexp_extract(_tidy(url), _AUTHORITY, 1), "@", -1)
    return F.lower(
        F.when(netloc.startswith("["), F.regexp_extract(netloc, r"^\[([^\]]*)", 1)).otherwise(
            F.substring_index(netloc, ":", 1)
        )
    )


def platform(h: Column) -> Column:
    """Platform label of a host name."""
    label = F.lit(K.DEFAULT_PLATFORM)
    for name, parts in reversed(K.PLATFORM_HOSTS.items()):
        hit = F.lit(False)
        for part in parts:
            hit = hit | h.contains(part)
        label = F.when(hit, F.lit(name)).otherwise(label)
    return label


def ats_company(url: Column) -> Column:
    return blank_to_null(F.regexp_extract(url, r"greenhouse\.io/([^/]+)/jobs/\d+", 1))


def ats_job_id(url: Column) -> Column:
    return blank_to_null(F.regexp_extract(url, r"greenhouse\.io/[^/]+/jobs/(\d+)", 1))


def root_domain(url: Column) -> Column:
    """Last two host labels after a leading ``www.``; null when there is no host."""
    return blank_to_null(F.substring_index(F.regexp_replace(host(url), r"^www\.", ""), ".", -2))


def is_board_domain(domain: Column) -> Column:
    hit = domain.isin(K.BOARD_DOMAINS)
    for board in K.BOARD_DOMAINS:
        hit = hit | domain.endswith("." + board)
    return hit


def profile_key(url: Column) -> Column:
    """Key under which two links to one profile are the same."""
    return F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"/+\z", "")


def redirect_target(href: Column) -> Column:
    """Link behind a search-result redirect, or the link itself if it is a profile."""
    targets = F.filter(query_items(_query(_tidy(href))), lambda x: x["k"] == "uddg")
    # the parameter is decoded once as a form value and once more as plain text, where + is +
    once = F.try_element_at(F.transform(targets, lambda x: x["v"]), F.lit(1))
    return F.coalesce(
        _decode(F.replace(once, F.lit("+"), F.lit("%2B"))),
        F.when(href.contains(K.PROFILE_URL), href),
    )


def profile_slug(url: Column) -> Column:
    """``<slug>`` of ``/in/<slug>``; '' when the path has another shape."""
    rest = F.substring_index(_before_fragment(_tidy(url)), "?", 1)
    path = F.regexp_replace(F.regexp_replace(rest, _SCHEME, ""), r"^//[^/]*", "")
    return F.regexp_extract(path, r"^/*in/+([^/]+)", 1)
