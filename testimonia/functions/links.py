"""Links of the pages where sources are found: URLs, file names, days and dates, kinds of documents, answers of a server."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Substrings of a page that asks whether its reader is a robot.
CHALLENGES = ["just a moment", "enable javascript and cookies", "cf-challenge", "__cf_bm", "checking your browser"]
# Links to videos.
VIDEO = r"(?i)(?:youtube\.com/(?:watch|live|embed|shorts)|youtu\.be/)"
# Months of dates in words.
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]
# A note that begins so says that the source no longer has the file.
MISSING = "Missing at source:"
# Days in headings and in names of files, the first pattern that matches.
DAY_HEADING = r"(?i)Day\s+(\d+)\s*[-–]\s*(\d{4}-\d{2}-\d{2})"


def is_bot_challenge(html: Column) -> Column:
    t = F.lower(html)
    out = F.lit(False)
    for m in CHALLENGES:
        out = out | t.contains(m)
    return out


def url_path(url: Column) -> Column:
    """The path of an URL; empty without one."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def file_of(url: Column) -> Column:
    return F.substring_index(url_path(url), "/", -1)


def is_pdf(url: Column) -> Column:
    return F.lower(F.regexp_replace(url_path(url), r";[^/]*$", "")).endswith(".pdf")


def is_video(url: Column) -> Column:
    return url.rlike(VIDEO)


def unquoted(s: Column) -> Column:
    """Percent escapes decoded; a plus stays a plus; what cannot be decoded stays."""
    return F.coalesce(F.try_url_decode(F.regexp_replace(F.regexp_replace(s, r"\+", "%2B"), r"%(?![0-9A-Fa-f]{2})", "%25")), s)


def quoted(s: Column) -> Column:
    """Percent escapes for all but letters, digits and _.-~, a blank being %20."""
    return F.replace(F.replace(F.replace(F.url_encode(s), F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, each part of the path escaped once, without parameters and fragment; the query stays."""
    u = F.trim(url)
    scheme, host = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)), F.lower(F.regexp_extract(u, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
    path = F.regexp_replace(url_path(u), r";[^/]*$", "")
    parts = F.transform(F.split(unquoted(path), "/", -1), quoted)
    query = F.regexp_extract(u, r"^[^?#]*\?([^#]*)", 1)
    out = F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")), F.when(host != "", F.concat(F.lit("//"), host)).otherwise(F.lit("")), F.array_join(parts, "/"))
    return F.when(query != "", F.concat(out, F.lit("?"), query)).otherwise(out)


def absolute_url(base: Column, href: Column) -> Column:
    """``href`` as seen from the page ``base``: whole, from the scheme, from the root, a query or fragment alone, or relative with dots."""
    root, scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1), F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    folder = F.regexp_replace(F.regexp_extract(base, r"^([^?#]*)", 1), r"(://[^/]*)$", "$1/")
    folder = F.regexp_replace(folder, r"[^/]*$", "")
    path = F.concat(F.regexp_replace(folder, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", ""), F.regexp_extract(href, r"^([^?#]*)", 1))
    rest = F.regexp_replace(href, r"^[^?#]*", "")
    # parts are taken up one by one: a dot is dropped, two take the part before away
    parts = F.split(path, "/", -1)
    walked = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array().cast("array<string>"), lambda a, x: F.when(x == ".", a).when(x == "..", F.slice(a, 1, F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.concat(a, F.array(x))))
    ends_open = F.element_at(parts, -1).isin(".", "..")
    relative = F.concat(root, F.lit("/"), F.array_join(walked, "/"), F.when(ends_open & (F.size(walked) > 0), F.lit("/")).otherwise(F.lit("")), rest)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href == "", base)
        .when(href.startswith("#"), F.concat(F.regexp_extract(base, r"^([^#]*)", 1), href))
        .when(href.startswith("?"), F.concat(F.regexp_extract(base, r"^([^?#]*)", 1), href))
        .when(href.startswith("/") & ~href.contains("/."), F.concat(root, href))
        .when(href.startswith("/"), F.concat(root, href))
        .otherwise(relative)
    )


def safe_filename(url: Column, day: Column) -> Column:
    """A file name of letters, digits, dots and hyphens from the last part of the path, with the day unless it says it; 200 characters at most."""
    n = F.trim(unquoted(file_of(url)))
    n = F.regexp_replace(F.regexp_replace(n, r"(?U)\s+", "_"), r"(?U)[^\w.\-]+", "_")
    n = F.regexp_replace(F.regexp_replace(n, "_+", "_"), "^_|_$", "")
    n = F.when(n == "", "document").otherwise(n)
    n = F.when(n.contains("."), n).otherwise(F.concat(n, F.lit(".bin")))
    mark = F.concat(F.lit("day_"), day.cast("string"))
    dated = F.concat(F.regexp_extract(n, r"^(.*)\.[^.]*$", 1), F.lit("_"), mark, F.lit("."), F.substring_index(n, ".", -1))
    return F.substring(F.when(day.isNotNull() & ~F.lower(n).contains(mark), dated).otherwise(n), 1, 200)


def file_extension(url: Column, filename: Column) -> Column:
    n = F.coalesce(F.nullif(filename, F.lit("")), unquoted(file_of(url)))
    return F.when(n.contains("."), F.concat(F.lit("."), F.lower(F.substring_index(n, ".", -1)))).otherwise(F.lit(""))


def day_number(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(?i)\bday[_\s]*(\d+)", 1), F.lit("")).cast("int")


def date_in(text: Column, filename: Column) -> Column:
    """An ISO date (also with slashes) in the text; else eight digits of the file name that are a date of 2020 to 2030; else a date in words."""
    iso = F.replace(F.nullif(F.regexp_extract(text, r"(\d{4}[-/]\d{2}[-/]\d{2})", 1), F.lit("")), F.lit("/"), F.lit("-"))
    eight = F.transform(F.regexp_extract_all(filename, F.lit(r"(\d{8})"), F.lit(1)), lambda x: F.when(F.substring(x, 1, 4).cast("int").between(2020, 2030), F.try_to_date(x, "yyyyMMdd")))
    eight = F.get(F.filter(eight, lambda x: x.isNotNull()), F.lit(0)).cast("string")
    p = r"(?i)\b(\d{1,2})\s+(" + "|".join(MONTHS) + r")\s+(\d{4})\b"
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.lower(F.regexp_extract(text, p, 2)))
    words = F.when(month > 0, F.try_to_date(F.concat_ws("-", F.regexp_extract(text, p, 3), F.lpad(month.cast("string"), 2, "0"), F.lpad(F.regexp_extract(text, p, 1), 2, "0")), "yyyy-MM-dd"))
    return F.coalesce(iso, eight, words.cast("string"))


def link_kind(text: Column, filename: Column, page: Column) -> tuple[Column, Column]:
    """(source_type, document_type) of a link; the file's own name comes before what is written around it."""
    both, page, name = F.lower(F.concat_ws(" ", text, filename)), F.lower(page), F.lower(filename)
    rules = [
        (both.contains("record"), "transcript", "Transcript"),
        (name.startswith("statement"), "statement", "WitnessStatement"),
        (name.contains("interim") | name.contains("report"), "report", "Report"),
        (page.contains("notice") | both.contains("notice"), "notice", "Notice"),
        (page.contains("media") | both.contains("media"), "media", "MediaStatement"),
        (both.contains("statement"), "statement", "WitnessStatement"),
        (both.contains("report"), "report", "Report"),
    ]
    return _first_of(rules, ("supporting_document", "SupportingDocument"))


def support_kind(text: Column, filename: Column) -> tuple[Column, Column]:
    """(source_type, document_type) of a supporting document."""
    both = F.lower(F.concat_ws(" ", text, filename))
    rules = [(both.contains("affidavit"), "statement", "Affidavit"), (both.contains("statement"), "statement", "WitnessStatement"), (both.contains("annexure"), "supporting_document", "Annexure"), (both.contains("report"), "report", "Report")]
    return _first_of(rules, ("supporting_document", "SupportingDocument"))


def _first_of(rules: list, other: tuple[str, str]) -> tuple[Column, Column]:
    a, b = F.lit(other[0]), F.lit(other[1])
    for test, x, y in reversed(rules):
        a, b = F.when(test, x).otherwise(a), F.when(test, y).otherwise(b)
    return a, b


def download_status(code: Column) -> Column:
    """What a server's answer means: ok, missing for good, rejected for now, or an error."""
    return F.when(code.between(200, 299), "ok").when(code.isin(404, 410), "missing").when(code.isin(403, 429, 503), "rejected").otherwise("error")


def content_fault(extension: Column, head: Column, size: Column) -> Column:
    """Why a file is refused, or null: a PDF must begin as one, a text must not be blank, nothing may be empty. ``head``: its first characters."""
    return (
        F.when((extension == ".pdf") & ~F.coalesce(head, F.lit("")).startswith("%PDF-"), "not a PDF")
        .when((extension == ".txt") & (F.trim(F.coalesce(head, F.lit(""))) == ""), "empty text")
        .when(~extension.isin(".pdf", ".txt") & (F.coalesce(size, F.lit(0)) == 0), "empty file")
    )


def is_missing_at_source(notes: Column) -> Column:
    return F.coalesce(notes, F.lit("")).startswith(MISSING)
