"""Not-modified revisit resolution for web archive records.

A revisit record says that a page hadn't changed.  It is resolved against the latest earlier full
response of the same canonical URL, an as-of join; validators of the two must agree (entity tags, compared
weakly; else modification dates; else payload digests), and of the revisit's headers only those that a
not-modified answer may update replace the response's.

The as-of join is a running maximum, cut into time slots of about equal numbers of records so that a hot
URL is shared among tasks: inside a slot by a window over (URL, slot), across slots by a second window over one row
per (URL, slot).

Records: record_id, url, ts (long), kind ("response" or "revisit"), digest, headers (map, lower-case names).
Defined results: a null or unparsable URL is its own text or null, and null URLs resolve with nothing; null ts
resolves with nothing and is nobody's source; equal times are not earlier; of responses at one time the
one with the largest record_id is taken; repeated rows are resolved one by one; null headers count as none; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLOTS = 64
#: Header fields that a not-modified answer may update.
PERMITTED = ("cache-control", "content-location", "date", "etag", "expires", "vary")
#: Query parameters that name no other page.
TRACKING = "utm_[a-z]+|ref|fbclid|gclid"


def canonical(url: Column) -> Column:
    """Scheme, "www.", default port, fragment, tracking parameters, closing slash and parameter order don't count; host in lower case."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), "#.*$", ""), "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(F.regexp_replace(F.lower(F.regexp_extract(bare, "^[^/?]*", 0)), "^www[.]", ""), ":(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(bare, "^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, "^[^?]*[?](.*)$", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)")))
    return F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def entries(headers: Column) -> Column:
    """A map as an array of (key, value) sorted by key, which can be compared."""
    return F.array_sort(F.map_entries(F.coalesce(headers, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))))


def value_of(headers: Column, name: str) -> Column:
    return F.try_element_at(F.transform(F.filter(headers, lambda e: e["key"] == name), lambda e: e["value"]), F.lit(1))


def resolve(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """One row per revisit: revisit_id, canonical_url, response_id, status, digest and headers (sorted entries).

    status: "resolved"; "changed" (validators differ); "unverified" (none in common); "unresolved" (no earlier response).
    Only resolved rows carry response_id, digest and merged headers.
    """
    cuts = records.select(F.percentile_approx("ts", [i / slots for i in range(1, slots)], 10_000).alias("cuts")).first()["cuts"] or []
    slot = F.size(F.filter(F.array(*[F.lit(c) for c in sorted(set(cuts))]), lambda c: c < F.col("ts"))) if cuts else F.lit(0)
    base = records.select(
        "record_id", canonical(F.col("url")).alias("canonical_url"), "ts", "kind", "digest", entries(F.col("headers")).alias("headers"), slot.alias("slot"),
    ).filter("kind IN ('response', 'revisit')")
    full = F.when((F.col("kind") == "response") & F.col("ts").isNotNull(), F.struct("ts", "record_id", "digest", "headers"))
    base = base.withColumn("source", full)
    place = ["canonical_url", "slot"]
    inside = Window.partitionBy(*place).orderBy("ts").rangeBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy("canonical_url").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = base.groupBy(*place).agg(F.max("source").alias("source")).select(*place, F.max("source").over(across).alias("before"))
    found = (base.withColumn("near", F.max("source").over(inside)).filter("kind = 'revisit'").drop("source")
             .join(carried, place, "left"))
    source = F.when(F.col("ts").isNotNull() & F.col("canonical_url").isNotNull(), F.coalesce("near", "before"))
    found = found.withColumn("source", source)
    tags = [F.regexp_replace(value_of(h, "etag"), "^W/", "") for h in (F.col("headers"), F.col("source.headers"))]
    dates = [value_of(h, "last-modified") for h in (F.col("headers"), F.col("source.headers"))]
    same = F.coalesce(tags[0] == tags[1], dates[0] == dates[1], F.col("digest") == F.col("source.digest"))
    status = (F.when(F.col("source").isNull(), "unresolved").when(same.isNull(), "unverified").when(same, "resolved").otherwise("changed"))
    may = F.filter("headers", lambda e: e["key"].isin(*PERMITTED))
    names = F.transform(may, lambda e: e["key"])
    merged = F.array_sort(F.concat(F.filter("source.headers", lambda e: ~F.array_contains(names, e["key"])), may))
    found = found.withColumn("status", status)
    ok = F.col("status") == "resolved"
    return found.select(F.col("record_id").alias("revisit_id"), "canonical_url", F.when(ok, F.col("source.record_id")).alias("response_id"), "status",
                        F.when(ok, F.col("source.digest")).alias("digest"), F.when(ok, merged).alias("headers"))


def records_of(pages: DataFrame) -> DataFrame:
    """Archive records that a crawl and three later visits of every page would have left.

    The first visit is a full response.  Then come a revisit under another spelling of the URL, a revisit that
    carries another entity tag on every seventh page, and on every fifth page a revisit before anything was stored.
    """
    page, digest = F.col("page_id"), F.sha1(F.col("html").cast("binary"))
    tag, modified = F.concat(F.lit('"'), F.substring(digest, 1, 12), F.lit('"')), F.concat(F.lit("day "), (page % 28).cast("string"))

    def headers(**fields):
        return F.create_map(*[x for name, value in fields.items() for x in (F.lit(name.replace("_", "-")), value)])

    def visit(step: int, kind: str, url: Column, fields: Column) -> Column:
        return F.struct((page * 4 + step).alias("record_id"), url.alias("url"), (page + (step - 1) * 10_000_000).alias("ts"), F.lit(kind).alias("kind"),
                        F.when(F.lit(kind) == "response", digest).alias("digest"), fields.alias("headers"))

    text = lambda s: F.lit(s)
    first = headers(content_type=text("text/html"), content_length=F.length("html").cast("string"), date=text("visit 1"), etag=tag, last_modified=modified, cache_control=text("max-age=60"))
    again = headers(date=text("visit 2"), etag=F.concat(F.lit("W/"), tag), content_length=text("0"), set_cookie=text("id=1"), expires=text("never"))
    other = headers(date=text("visit 3"), etag=F.when(page % 7 == 0, F.lit('"other"')).otherwise(tag), cache_control=text("no-store"))
    early = headers(date=text("visit 0"), last_modified=modified)
    spelt = F.concat(F.lit("HTTPS://WWW."), F.regexp_replace(F.regexp_replace("url", "^https?://(www[.])?", ""), "#.*$", ""),
                     F.when(F.contains(F.col("url"), F.lit("?")), "&utm_medium=x").otherwise("?utm_medium=x"), F.lit("#part"))
    visits = F.array(visit(1, "response", F.col("url"), first), visit(2, "revisit", spelt, again), visit(3, "revisit", F.col("url"), other))
    visits = F.when(page % 5 == 0, F.concat(visits, F.array(visit(0, "revisit", F.col("url"), early)))).otherwise(visits)
    return pages.select(F.explode(visits).alias("v")).select("v.*")


def digest_columns(resolved: DataFrame) -> DataFrame:
    """The resolved rows with their headers as one text."""
    text = F.array_join(F.transform("headers", lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return resolved.select("revisit_id", "canonical_url", "response_id", "status", "digest", text.alias("headers"))
