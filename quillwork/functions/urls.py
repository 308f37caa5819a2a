"""URL1: references resolved against a base, as RFC 3986 (5.2) has it, in Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Scheme, authority, path, query and fragment, each with its mark, so that a part that is there but empty differs from none.
_PARTS = r"(?s)\A([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/?#]*)?([^?#]*)(\?[^#]*)?(#.*)?\z"


def parts(url: Column) -> list[Column]:
    """Scheme with `:`, authority with `//`, path, query with `?` and fragment with `#`; '' for what is not there."""
    return [F.regexp_extract(url, _PARTS, i) for i in range(1, 6)]


def without_dots(path: Column) -> Column:
    """A path without `.` and `..` segments; `..` at the root stays there."""
    rooted = path.startswith("/")
    segments = F.split(F.when(rooted, F.substring(path, F.lit(2), F.length(path))).otherwise(path), "/")

    def step(out: Column, s: Column) -> Column:
        up = F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(0)))
        return F.when(s == ".", out).when(s == "..", up).otherwise(F.concat(out, F.array(s)))

    kept = F.aggregate(segments, F.array().cast("array<string>"), step)
    last = F.element_at(segments, -1)
    tail = F.when(last.isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    # a lone empty segment behind nothing is the root itself
    return F.concat(F.when(rooted, "/").otherwise(""), F.array_join(tail, "/"))


def join_url(base: Column, reference: Column) -> Column:
    """The reference as seen from base; null where either is null or base has no scheme."""
    scheme, authority, path, query, _ = parts(base)
    r_scheme, r_authority, r_path, r_query, r_fragment = parts(reference)
    merged = F.when((authority != "") & (path == ""), F.concat(F.lit("/"), r_path)).otherwise(F.concat(F.regexp_replace(path, r"[^/]*\z", ""), r_path))
    own = (r_scheme != "") | (r_authority != "")
    target_path = F.when(own | r_path.startswith("/"), without_dots(r_path)).when(r_path == "", path).otherwise(without_dots(merged))
    target_query = F.when(~own & (r_path == "") & (r_query == ""), query).otherwise(r_query)
    joined = F.concat(F.when(r_scheme != "", r_scheme).otherwise(scheme), F.when(own, r_authority).otherwise(authority), target_path, target_query, r_fragment)
    return F.when(base.isNotNull() & reference.isNotNull() & (scheme != ""), joined)
