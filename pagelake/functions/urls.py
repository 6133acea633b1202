"""Column functions over urls and endpoints. All of them stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^:/?#]*)"
# Characters a path may hold as they are, and runs of those or of others.
_PATH_SAFE = r"A-Za-z0-9._~/!$&'()*+,;=:@-"
_PLAIN_PATH = rf"^[{_PATH_SAFE}]*\z"
_PATH_RUNS = rf"([{_PATH_SAFE}]+|[^{_PATH_SAFE}]+)"


def url_host(url: Column) -> Column:
    """Lower-case host of an absolute url, ``''`` when there is none."""
    return F.lower(F.regexp_extract(url, _HOST, 1))


def in_domains(url: Column, domains: list[str]) -> Column:
    """True when the host is one of the domains or lies below one."""
    host = url_host(url)
    test = F.lit(False)
    for domain in domains:
        d = domain.lower()
        test = test | (host == d) | host.endswith("." + d)
    return test


def host_key(url: Column) -> Column:
    """The host's labels from the right: ``m.book.example`` is ``example.book.m``.

    Hosts of one domain share a prefix of it and so sort together.
    """
    return F.array_join(F.reverse(F.split(url_host(url), r"\.")), ".")


def key_in_domains(key: Column, domains: list[str]) -> Column:
    """:func:`in_domains` on a stored :func:`host_key`; parquet can prune by it."""
    test = F.lit(False)
    for domain in domains:
        prefix = ".".join(reversed(domain.lower().split(".")))
        test = test | (key == prefix) | key.startswith(prefix + ".")
    return test


def url_matches(url: Column, pattern: str) -> Column:
    """Regular expression search (not a full match), in Java syntax."""
    return url.rlike(pattern)


def decoded_url(url: Column) -> Column:
    """Percent escapes decoded, so that patterns see the characters meant.

    Run by run: escapes that spell no text stay, and the others are decoded.
    """
    runs = F.regexp_extract_all(url, F.lit("((?:%[0-9A-Fa-f]{2})+|[^%]+|%)"), F.lit(1))
    plain = F.transform(
        runs, lambda r: F.when(F.startswith(r, F.lit("%")), F.coalesce(F.try_url_decode(r), r)).otherwise(r)
    )
    return F.when(F.contains(url, F.lit("%")), F.array_join(plain, "")).otherwise(url)


def _without_dots(path: Column) -> Column:
    """Resolve ``.`` and ``..`` segments; paths without them pass unchanged."""
    segments = F.split(path, "/")
    # The leading empty segment stays, so '..' at the root has nothing to drop.
    folded = F.aggregate(
        segments,
        F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == ".", acc)
        .when(
            seg == "..",
            F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc),
        )
        .otherwise(F.concat(acc, F.array(seg))),
    )
    ends_in_dir = F.get(segments, F.size(segments) - 1).isin(".", "..")
    joined = F.concat(
        F.array_join(folded, "/"), F.when(ends_in_dir, F.lit("/")).otherwise(F.lit(""))
    )
    return F.when(path.rlike(r"/\.{1,2}(?:/|\z)"), joined).otherwise(path)


def base_parts(base: Column) -> dict[str, Column]:
    """The pieces of a page url against which its links are resolved."""
    document = F.substring_index(F.substring_index(base, "#", 1), "?", 1)
    origin = F.regexp_extract(base, _ORIGIN, 1)
    path = F.substring(document, F.length(origin) + 1, F.length(document))
    directory = F.regexp_extract(path, r"^(.*/)", 1)
    return {
        "base": base,
        "scheme": F.regexp_extract(base, _SCHEME, 0),
        "origin": origin,
        "directory": F.when(directory == "", F.lit("/")).otherwise(directory),
        "document": document,
    }


def resolve_against(link: Column, parts: dict[str, Column]) -> Column:
    """Absolute form of ``link``, given :func:`base_parts` of its page."""
    path = F.regexp_extract(link, r"^[^?#]*", 0)
    tail = F.substring(link, F.length(path) + 1, F.length(link))
    full = F.when(path.startswith("/"), path).otherwise(
        F.concat(parts["directory"], path)
    )
    # First what nearly all links are: a plain path from the root.
    rooted = link.startswith("/") & ~link.startswith("//")
    return (
        F.when(rooted & ~F.contains(link, F.lit("/.")), F.concat(parts["origin"], link))
        .when(link == "", parts["base"])
        .when(link.rlike(_SCHEME), link)
        .when(link.startswith("//"), F.concat(parts["scheme"], link))
        .when(link.startswith("?"), F.concat(parts["document"], link))
        .when(
            link.startswith("#"),
            F.concat(F.substring_index(parts["base"], "#", 1), link),
        )
        .otherwise(F.concat(parts["origin"], _without_dots(full), tail))
    )


def resolve_url(link: Column, base: Column) -> Column:
    """Make a link absolute against the url of the page that holds it."""
    return resolve_against(link, base_parts(base))


def _form_decode(value: Column) -> Column:
    return F.coalesce(F.try_url_decode(value), value)


def _form_encode(value: Column) -> Column:
    encoded = F.replace(F.url_encode(value), F.lit("*"), F.lit("%2A"))
    return F.replace(encoded, F.lit("%7E"), F.lit("~"))


def _canonical_query(query: Column) -> Column:
    def pair(arg: Column) -> Column:
        key = F.substring_index(arg, "=", 1)
        rest = F.substring(arg, F.length(key) + 2, F.length(arg))
        return F.struct(_form_decode(key).alias("k"), _form_decode(rest).alias("v"))

    pairs = F.array_sort(
        F.transform(F.filter(F.split(query, "&"), lambda x: x != ""), pair)
    )
    return F.array_join(
        F.transform(
            pairs,
            lambda p: F.concat(_form_encode(p["k"]), F.lit("="), _form_encode(p["v"])),
        ),
        "&",
    )


def _canonical_path(path: Column) -> Column:
    def escape(run: Column) -> Column:
        return F.when(run.rlike(_PLAIN_PATH), run).otherwise(
            F.replace(F.url_encode(run), F.lit("+"), F.lit("%20"))
        )

    def part(escaped: Column) -> Column:
        runs = F.regexp_extract_all(decoded_url(escaped), F.lit(_PATH_RUNS), F.lit(1))
        return F.array_join(F.transform(runs, escape), "")

    # An escaped slash is data and no separator: it must survive the decoding.
    parts = F.transform(F.split(path, "%2[fF]"), part)
    return F.when(path.rlike(_PLAIN_PATH), path).otherwise(F.array_join(parts, "%2F"))


def canonical_url(
    url: Column, drop_query: bool = False, drop_slash: bool = False
) -> Column:
    """One spelling per page: no fragment, lower-case host, sorted and evenly
    escaped query arguments, evenly escaped path, ``/`` for an empty path.

    ``drop_query`` and ``drop_slash`` also merge urls that differ only in their
    arguments or in a final ``/``.
    """
    bare = F.substring_index(url, "#", 1)
    head = F.substring_index(bare, "?", 1)
    query = F.substring(bare, F.length(head) + 2, F.length(bare))
    origin = F.substring_index(head, "/", 3)
    raw_path = F.substring(head, F.length(origin) + 1, F.length(head))
    path = F.when(raw_path == "", F.lit("/")).otherwise(_canonical_path(raw_path))
    if drop_slash:
        path = F.when(
            (F.length(path) > 1) & path.endswith("/"), F.rtrim(path, F.lit("/"))
        ).otherwise(path)
    out = F.concat(F.lower(origin), path)
    if drop_query:
        return out
    args = _canonical_query(query)
    return F.when((query == "") | (args == ""), out).otherwise(
        F.concat(out, F.lit("?"), args)
    )


def url_fingerprint(url: Column) -> Column:
    """40-character id of the canonical url, the key for every url shuffle."""
    return F.sha1(canonical_url(url).cast("binary"))


def split_endpoint(endpoint: Column) -> Column:
    """``http://ip:port`` to a struct of ip, port and ``ip:port``.

    Null, empty or malformed input gives null fields instead of an error.
    """
    pattern = r"^(?:[A-Za-z][A-Za-z0-9+.-]*://)?([^:/?#]+:[0-9]{1,5})(?![0-9])"
    both = F.nullif(F.regexp_extract(endpoint, pattern, 1), F.lit(""))
    return F.struct(
        F.substring_index(both, ":", 1).alias("ip"),
        F.substring_index(both, ":", -1).cast("int").alias("port"),
        both.alias("endpoint"),
    )


def join_endpoint(ip: Column, port: Column) -> Column:
    """``ip:port``."""
    return F.concat(ip, F.lit(":"), port.cast("string"))


def endpoint_url(ip: Column, port: Column) -> Column:
    """``http://ip:port``."""
    return F.concat(F.lit("http://"), join_endpoint(ip, port))
