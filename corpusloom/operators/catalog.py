"""Download catalogue and media library rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

# Form values that state visibility, and ticked-box placeholders.
VISIBILITY_VALUES = ["yes", "no", "1", "0"]
CHECKBOX_VALUES = ["1", "on", "yes"]


def first_value(*candidates: Column) -> Column:
    """First candidate with visible text, cleaned; '' when there is none."""
    return F.coalesce(*[T.empty_to_null(T.clean_text(c)) for c in candidates], F.lit(""))


def resolve_file_value(value: Column, page_url: Column) -> tuple[Column, Column]:
    """Address and resolution status of a raw file value."""
    raw = T.strip(value)
    origin = F.regexp_extract(page_url, r"\A([a-z]+://[^/]+)", 1)
    url = F.when(T.is_absolute(raw), raw).when(raw.startswith("/"), F.concat(origin, raw)).otherwise("")
    status = (  # fixed values: the names that readers of the catalogue know
        F.when(T.is_absolute(raw), "direct_url")
        .when(raw.startswith("/"), "relative_url")
        .otherwise("filename_only_unresolved")
    )
    return url, status


THUMBNAIL = r"-[0-9]+x[0-9]+\.[A-Za-z0-9]+(?:\?.*)?\z"


def original_url(field: Column, attribute: Column, hrefs: Column, marker: str = "/uploads/") -> Column:
    """Address of the original file: form field, then attribute, then the first
    upload link that is no scaled copy."""
    usable = F.filter(hrefs, lambda h: h.contains(marker) & ~h.rlike(THUMBNAIL))
    field, attribute = T.clean_text(field), T.clean_text(attribute)
    return (
        F.when(T.is_absolute(field), field)
        .when(T.is_absolute(attribute), attribute)
        .otherwise(F.coalesce(F.get(usable, F.lit(0)), F.lit("")))
    )


def related_values(pairs: Column) -> Column:
    """Ticked values: label before value, placeholders dropped, first seen kept.

    ``pairs`` is an array of (label, value) structs in form order.
    """
    chosen = F.transform(pairs, lambda p: first_value(p["label"], p["value"]))
    return F.array_distinct(F.filter(chosen, lambda c: (c != "") & ~c.isin(CHECKBOX_VALUES)))


def row_roles(values: Column) -> tuple[Column, Column, Column]:
    """(file, name, status) out of the control values of one form row."""
    filled = F.filter(F.transform(values, lambda x: T.clean_text(x)), lambda x: x != "")
    file = F.coalesce(F.get(F.filter(filled, T.is_file_like), F.lit(0)), F.lit(""))
    shows = lambda x: F.lower(x).isin(VISIBILITY_VALUES)
    name = F.coalesce(F.get(F.filter(filled, lambda x: (x != file) & ~shows(x)), F.lit(0)), F.lit(""))
    status = F.coalesce(F.get(F.filter(filled, shows), F.lit(0)), F.lit(""))
    return file, name, status


def catalogue_rows(forms: DataFrame, page_url: Column) -> DataFrame:
    """Download rows of catalogue entries.

    ``forms`` has (entry_id, seq, values): the control values of one form row.
    Rows without a file are dropped; a repeated (name, file) of an entry counts
    once; rows are numbered within the entry.
    """
    from .dedupe import first_wins, numbered

    file, name, status = row_roles(F.col("values"))
    rows = forms.select(
        "entry_id", "seq", file.alias("raw_file_value"), name.alias("display_name"), status.alias("display_status")
    ).filter("raw_file_value <> ''")
    unique = first_wins(rows, ["entry_id", "display_name", "raw_file_value"], "seq")
    url, resolution = resolve_file_value(F.col("raw_file_value"), page_url)
    placed = numbered(unique, ["seq"], ["entry_id"], "row_number")
    return placed.withColumn("resolved_url", url).withColumn("resolution_status", resolution)


def listing(links: DataFrame, base_url: str, marker: str = "post.php", key: str = "page_id") -> DataFrame:
    """Edit links of saved listing pages, one row per address.

    The first mention gives the place, the last one the title.
    """
    address = F.when(T.is_absolute(F.col("href")), F.col("href")).otherwise(T.join_base(F.lit(base_url), F.col("href")))
    rows = links.select(key, "pos", address.alias("edit_url"), T.clean_text(F.col("label")).alias("title"))
    rows = rows.filter(F.col("edit_url").contains(marker) & F.col("edit_url").contains("action=edit"))
    place = F.struct(key, "pos")
    return rows.groupBy("edit_url").agg(
        F.min(place).alias("_at"), F.max_by("title", place).alias("post_title")
    ).select(
        T.query_param(F.col("edit_url"), "post").alias("post_id"), "post_title", "edit_url",
        F.col(f"_at.{key}").alias("listing_page"), F.col("_at.pos").alias("position"),
    )


def classify_fetch(
    http_status: Column,
    content_type: Column,
    body_text: Column,
    error_class: Column,
    content_length: Column,
    existing_size: Column,
    missing_markers: tuple[str, ...] = ("file does not exist",),
) -> Column:
    """Outcome of one fetch of a media file."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))
    missing = F.lit(False)
    for marker in missing_markers:
        missing = missing | F.lower(F.coalesce(body_text, F.lit(""))).contains(marker)
    expected = F.coalesce(content_length, F.lit(0))
    return (  # fixed values: the names that readers of the inventory know
        F.when(error_class == "timeout", "timeout")
        .when(F.coalesce(error_class, F.lit("")) != "", "failed")
        .when(http_status == 404, "missing_server_file")
        .when(http_status >= 400, "failed")
        .when(kind.contains("text/html") & missing, "missing_server_file")
        .when(kind.contains("text/html"), "failed")
        .when(existing_size.isNotNull() & ((expected == 0) | (existing_size == expected)), "skipped_existing")
        .otherwise("downloaded")
    )


def download_labels(df: DataFrame, key: str, html: str, base: Column, marker: str) -> DataFrame:
    """Label of every download link: its text, title or aria-label, else the text
    of the enclosing item, else a number. One row per address and page."""
    from ..functions import html as H
    from .dedupe import first_wins

    clean = H.drop_noise(F.col(html))
    anchors = F.regexp_extract_all(clean, F.lit(H.ANCHOR), F.lit(0))
    texts = F.split(clean, H.ANCHOR)
    around = F.transform(
        anchors,
        lambda a, i: F.struct(a.alias("tok"), F.get(texts, i).alias("before"), F.get(texts, i + 1).alias("after")),
    )
    # Positions count only the links that carry the marker.
    chosen = F.filter(around, lambda x: F.regexp_extract(x["tok"], H.ANCHOR_OPEN, 0).contains(marker))
    rows = df.select(key, base.alias("_base"), F.posexplode(chosen).alias("index", "_a")).select(
        key, "_base", "index", "_a.*"
    )
    opening = F.regexp_extract("tok", H.ANCHOR_OPEN, 0)
    href = H.attribute(opening, "href")
    container = r"(?is)\A(?:.*<(?:li|tr|div)(?:\s[^>]*)?>)?(.*)\z"
    head = F.regexp_extract("before", container, 1)
    tail = F.regexp_extract("after", r"(?is)\A(.*?)(?:</(?:li|tr|div)\s*>|\z)", 1)
    label = F.coalesce(
        T.empty_to_null(T.clean_text(H.tag_text(F.col("tok")))),
        T.empty_to_null(T.clean_text(H.attribute(opening, "title"))),
        T.empty_to_null(T.clean_text(H.attribute(opening, "aria-label"))),
        T.empty_to_null(T.clean_text(H.tag_text(F.concat(head, F.col("tok"), tail)))),
        F.concat(F.lit("Download "), (F.col("index") + 1).cast("string")),
    )
    url = F.when(T.is_absolute(href), href).otherwise(T.join_base(F.col("_base"), href))
    found = rows.filter(href != "").select(key, "index", label.alias("label"), url.alias("url"))
    return first_wins(found, [key, "url"], "index")


def images(df: DataFrame, key: str, html: str, base: Column) -> DataFrame:
    """Images with a source, numbered within the article, with their file name."""
    from ..functions import html as H

    found = F.regexp_extract_all(H.drop_noise(F.col(html)), F.lit(H.IMAGE), F.lit(0))
    sources = F.filter(F.transform(found, lambda t: H.attribute(t, "src")), lambda s: s != "")
    rows = df.select(key, base.alias("_base"), F.posexplode(sources).alias("_i", "src"))
    number = (F.col("_i") + 1).cast("string")
    padded = F.lpad(number, F.greatest(F.length(number), F.lit(3)), F.lit("0"))
    return rows.select(
        key,
        (F.col("_i") + 1).cast("bigint").alias("ordinal"),
        "src",
        F.when(T.is_absolute(F.col("src")), F.col("src")).otherwise(T.join_base(F.col("_base"), F.col("src"))).alias("image_url"),
        F.concat(F.lit("image_"), padded, F.lit(".png")).alias("image_name"),
    )


def image_totals(articles: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """Images per article and the addresses that failed, in article order.

    ``found`` has (key, ordinal, image_url, ok); only one article's own images meet.
    """
    failed = F.when(~F.col("ok"), F.struct("ordinal", "image_url"))
    totals = found.groupBy(key).agg(
        F.count("*").alias("image_count"), F.array_sort(F.collect_list(failed)).alias("_failed")
    )
    return articles.join(totals, key, "left").select(
        *articles.columns,
        F.coalesce("image_count", F.lit(0)).cast("bigint").alias("image_count"),
        F.coalesce(F.col("_failed.image_url"), F.array().cast("array<string>")).alias("failed_images"),
    )


def package_metadata(articles: DataFrame, source_system: str) -> DataFrame:
    """Record of a packaged article (title, summary, url, image counts given)."""
    slug = T.legacy_slug(F.col("title"))
    return articles.select(
        F.lit(source_system).alias("source_system"),
        "title", "summary", "source_url",
        slug.alias("slug"),
        F.concat(F.lit("packages/"), slug).alias("package_folder"),
        "image_count", "failed_images",
        F.lit("packaged").alias("status"),
    )


# Column order of the flat inventories.
CATALOGUE_FIELDS = ["post_id", "post_title", "edit_url", "row_number", "display_name", "raw_file_value", "resolved_url", "resolution_status", "display_status", "download_section", "related_software"]
# Names and order that consumers read.
MEDIA_FIELDS = ["sequence", "attachment_id", "title", "listed_filename", "original_url", "status", "saved_filename", "saved_path", "size_bytes", "sha256", "content_type", "http_status", "listed_date", "author", "caption", "alt_text", "description", "edit_url", "downloaded_at_utc", "error"]
# Names and order that consumers read.
DOWNLOAD_FIELDS = ["sequence", "label", "source_url", "status", "method", "saved_filename", "saved_path", "size_bytes", "sha256", "downloaded_at_utc", "error"]


def flat(df: DataFrame, fields: list[str]) -> DataFrame:
    """Fixed field list as text: absent or null becomes '', extra columns are dropped,
    list columns are joined."""
    types = dict(df.dtypes)

    def cell(name: str) -> Column:
        if name not in types:
            return F.lit("").alias(name)
        value = T.list_text(F.col(name)) if types[name].startswith("array") else F.col(name).cast("string")
        return F.coalesce(value, F.lit("")).alias(name)

    return df.select(*[cell(f) for f in fields])


def open_items(selected: DataFrame, inventory: DataFrame, key: str) -> DataFrame:
    """Items a rerun still has to fetch: not yet complete in the inventory."""
    complete = inventory.filter(F.col("status").isin("downloaded", "skipped_existing"))
    return selected.join(complete.select(key), key, "left_anti")
