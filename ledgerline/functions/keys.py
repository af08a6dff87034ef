"""Identifiers, paths and digests of records, as column expressions."""

from __future__ import annotations

import mimetypes

from pyspark.sql import Column
from pyspark.sql import functions as F

INSTANT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"
INSTANT_FORM = "yyyy-MM-dd'T'HH:mm:ss'Z'"
PAGE_SIZE = 200


def identifier(prefix: str) -> str:
    return prefix + "-[0-9]{4}-[0-9]{2}-[0-9]{2}-[0-9]{6}"


def coordinate(id_: Column, prefix: str, page_size: int = PAGE_SIZE) -> Column:
    """year, day, serial and page of an identifier; null where it has another shape."""
    shape = rf"^{prefix}-(([0-9]{{4}})-[0-9]{{2}}-[0-9]{{2}})-([0-9]{{6}})$"
    serial = F.regexp_extract(id_, shape, 3).cast("long")
    page = F.floor((serial - 1) / page_size).cast("long") + 1
    return F.when(id_.rlike(shape), F.struct(F.regexp_extract(id_, shape, 2).alias("year"), F.regexp_extract(id_, shape, 1).alias("day"), serial.alias("serial"), page.alias("page")))


def strict_coordinate(id_: Column, prefix: str, page_size: int = PAGE_SIZE) -> Column:
    """As coordinate; an identifier of another shape is an error."""
    found = coordinate(id_, prefix, page_size)
    return F.when(found.isNull(), F.raise_error(F.concat(F.lit("not an identifier: "), id_)).cast("struct<year:string,day:string,serial:long,page:long>")).otherwise(found)


def strict_instant(text: Column) -> Column:
    """Whether text is an instant of second precision that exists."""
    return F.coalesce(text.rlike(INSTANT) & F.try_to_timestamp(text, F.lit(INSTANT_FORM)).isNotNull(), F.lit(False))


def calendar_day(text: Column) -> Column:
    """Whether text is a day of the calendar, written as such."""
    day = F.to_date(F.try_to_timestamp(text, F.lit("yyyy-MM-dd")))
    return F.coalesce(text.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & (F.date_format(day, "yyyy-MM-dd") == text), F.lit(False))


def identity_digest(repository: Column, project_path: Column, config_path: Column) -> Column:
    """sha256 of the three parts with a NUL between them; an absent part is empty."""
    nul = F.unhex(F.lit("00"))
    part = lambda c: F.encode(F.coalesce(c, F.lit("")), "UTF-8")
    return F.sha2(F.concat(part(F.lower(repository)), nul, part(project_path), nul, part(config_path)), 256)


def tuple_digest(path: Column, size: Column, sha256: Column) -> Column:
    """sha256 of path, decimal size and digest, each after its length in eight bytes, big-endian."""

    def counted(c: Column) -> Column:
        return F.concat(F.unhex(F.lpad(F.hex(F.octet_length(c)), 16, "0")), F.encode(c, "UTF-8"))

    return F.sha2(F.concat(counted(path), counted(size.cast("string")), counted(sha256)), 256)


def blob_id(content: Column) -> Column:
    """The id that git gives a blob of these bytes."""
    return F.sha1(F.concat(F.encode(F.concat(F.lit("blob "), F.octet_length(content).cast("string")), "UTF-8"), F.unhex(F.lit("00")), F.encode(content, "UTF-8")))


def percent_encoded_path(path: Column) -> Column:
    """Each segment of a path percent-encoded, the slashes kept."""
    return F.array_join(F.transform(F.split(path, "/"), lambda s: F.replace(F.url_encode(s), F.lit("+"), F.lit("%20"))), "/")


def safe_relative_path(path: Column, allow_dot: bool = False) -> Column:
    """Whether a path is relative, canonical and free of anything that leads elsewhere."""
    parts = F.split(path, "/")
    bad = path.rlike(r"^$|^/|//|\\|:|[?#]|/$|[\x00-\x1f\x7f]") | F.array_contains(parts, "..")
    dot = F.array_contains(parts, ".")
    return F.coalesce(~bad & (~dot | ((path == ".") if allow_dot else F.lit(False))), F.lit(False))


#: How files of a licence are called.
LICENSE_NAME = r"(?i)^(?:licen[cs]e|copying|unlicense|ofl)(?:\.(?:md|markdown|txt))?$"


def license_filename(name: Column) -> Column:
    return name.rlike(LICENSE_NAME)


#: How public paths are classed.
IMMUTABLE_PREFIXES = ("entries/", "renders/", "evidence/")
STABLE_PATHS = ("feed.xml", "recent.json", "recent-renders.json", "source-availability.json", "source-availability-targets.json")
STABLE_PREFIXES = ("feeds/", "versions/", "registration-identities/", "repositories/", "browse/", "search/", "subjects/", "tombstones/")
FROZEN_PREFIXES = ("entries/", "renders/", "evidence/", "scores/", "registrations/submissions/", "migrations/")
PUBLIC_PREFIX = "public/"


def _starts(path: Column, prefixes: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for p in prefixes:
        out = out | path.startswith(p)
    return out


def object_class(path: Column) -> Column:
    """stable, immutable or snapshot; what nobody has classed is a snapshot."""
    own = F.regexp_replace(path, "^/", "")
    return F.when(own.isin(*STABLE_PATHS) | _starts(own, STABLE_PREFIXES), "stable").when(_starts(own, IMMUTABLE_PREFIXES), "immutable").otherwise("snapshot")


def frozen_path(path: Column, prefixes: tuple[str, ...] = FROZEN_PREFIXES) -> Column:
    return _starts(path, prefixes)


#: Media types that systems add to the standard table.
MORE_TYPES = {".ts": "video/mp2t", ".woff": "font/woff", ".woff2": "font/woff2"}


def content_type(path: Column) -> Column:
    """The media type by a path's ending: three forms of its own, else what the standard table of endings says, with a charset for text."""
    known = mimetypes.MimeTypes()
    packed, types = known.encodings_map, {**known.types_map[True], **MORE_TYPES}
    ending = F.lower(F.regexp_extract(path, r"[^/.][^/]*?(\.[^./]*)$", 1))
    inner = F.lower(F.regexp_extract(path, r"[^/.][^/]*?(\.[^./]*)\.[^./]*$", 1))
    own = F.when(ending.isin(*map(str.lower, packed)), inner).otherwise(ending)
    guessed = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(types.items()) for x in pair]), own)
    text = guessed.startswith("text/") | (guessed == "application/javascript")
    return (
        F.when(path.endswith(".json"), "application/json; charset=utf-8")
        .when(path.endswith(".xml"), "application/rss+xml; charset=utf-8")
        .when((path == "LICENSE") | path.endswith(".md") | path.endswith(".txt"), "text/plain; charset=utf-8")
        .when(guessed.isNull(), "application/octet-stream")
        .otherwise(F.when(text, F.concat(guessed, F.lit("; charset=utf-8"))).otherwise(guessed))
    )


def path_kind(path: Column, prefix: str) -> Column:
    """Which canonical document a path names; null for none."""
    id_ = identifier(prefix)
    # The forms of canonical paths.
    kinds = {
        "entry": rf"entries/{id_}-v[1-9][0-9]*\.json",
        "score": rf"scores/{id_}-v[1-9][0-9]*\.json",
        "result": rf"registrations/results/{id_}\.json",
        "submission": r"registrations/submissions/[a-z0-9]{12}\.json",
        "day": r"registrations/days/[0-9]{4}-[0-9]{2}-[0-9]{2}\.json",
        "identity": r"registrations/identities/[0-9a-f]{64}\.json",
        "render": rf"renders/{id_}-v[1-9][0-9]*/.+",
        "evidence": rf"evidence/{id_}-v[1-9][0-9]*/.+",
        "tombstone": rf"tombstones/{id_}-v[1-9][0-9]*\.json",
    }
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(kinds.items()):
        out = F.when(path.rlike(f"^(?:{pattern})$"), kind).otherwise(out)
    return out


def served_path(path: Column, prefix: str) -> Column:
    """Whether a path has the form of a derived document that is served."""
    id_, code = identifier(prefix), r"[a-z]+/[A-Za-z0-9.-]+"
    pages = r"(?:[0-9]{4}\.json|[0-9]{4}-[0-9]{2}-[0-9]{2}/[1-9][0-9]*\.json)"
    # The forms of served paths.
    forms = (
        r"feed\.xml", r"recent\.json", rf"versions/{id_}\.json", r"registration-identities/[0-9a-f]{64}\.json",
        r"repositories/[a-z0-9_.-]+/[a-z0-9_.-]+\.json", rf"browse/(?:index\.json|{pages})", rf"feeds/{code}\.xml",
        rf"subjects/{code}\.json", rf"subjects/{code}/{pages}", rf"tombstones/{id_}-v[1-9][0-9]*\.json",
        r"search/stopwords\.json", r"search/t/[a-z0-9]{2,32}/(?:head|[0-9]{1,4})\.json",
    )
    return path.rlike("^(?:" + "|".join(forms) + ")$")


def dependency_rank(path: Column) -> Column:
    """0 for pages, 1 for year documents, 2 for heads: what names others is written after them."""
    own = F.when(path.startswith(PUBLIC_PREFIX), F.substring(path, F.lit(len(PUBLIC_PREFIX) + 1), F.length(path))).otherwise(path)
    return F.when(own.rlike(r"^(?:browse|subjects/[^/]*/[^/]*)/[0-9]{4}\.json$"), 1).when(own.rlike(r"^(?:browse/index\.json|subjects/[^/]*/[^/]*|search/t/[^/]*/head\.json)$"), 2).otherwise(0)
