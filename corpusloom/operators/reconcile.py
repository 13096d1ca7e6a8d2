"""Publish plans: canonical corpus against what a destination already holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import text as T
from .dedupe import last_wins, numbered
from .links import rewrite, targets


def _folded(c: Column) -> Column:
    return T.fold(T.strip(c))


def resolve_remote(articles: DataFrame, state: DataFrame, remotes: DataFrame, adopt_existing: bool = True) -> DataFrame:
    """Remote record per article: saved id, else permalink = slug, else folded title.

    ``articles``: id, slug, title; ``state``: id, remote_id; ``remotes``:
    remote_id, permalink, remote_title, seq. Each lookup side is unique by key.
    """
    by_id = remotes.filter("coalesce(remote_id, '') <> ''").select(F.col("remote_id").alias("saved_id")).distinct()
    rows = articles.join(state.select("id", F.col("remote_id").alias("saved_id")), "id", "left")
    rows = rows.join(by_id.withColumn("by_id", F.col("saved_id")), "saved_id", "left")
    if not adopt_existing:
        return rows.withColumn("remote_id", F.col("by_id")).drop("saved_id", "by_id")
    slugs = remotes.filter("coalesce(permalink, '') <> ''").select(F.col("permalink").alias("slug"), F.col("remote_id").alias("by_slug"), "seq")
    titles = remotes.filter("coalesce(remote_title, '') <> ''").select(
        _folded(F.col("remote_title")).alias("_t"), F.col("remote_id").alias("by_title"), "seq"
    )
    rows = rows.join(last_wins(slugs, "slug", "seq").drop("seq"), "slug", "left")
    rows = rows.withColumn("_t", _folded(F.col("title"))).join(last_wins(titles, "_t", "seq").drop("seq"), "_t", "left")
    return rows.withColumn("remote_id", F.coalesce("by_id", "by_slug", "by_title")).drop("saved_id", "by_id", "by_slug", "by_title", "_t")


def import_plan(resolved: DataFrame, state: DataFrame, force: bool = False) -> DataFrame:
    """created / skipped / updated per article; skipped when the stored hash is unchanged."""
    held = state.select("id", F.col("html_sha256").alias("_held"))
    same = F.lit(not force) & F.coalesce(F.col("_held") == F.col("html_sha256"), F.lit(False))
    action = F.when(F.col("remote_id").isNull(), "created").when(same, "skipped").otherwise("updated")
    return resolved.join(held, "id", "left").withColumn("action", action).drop("_held")


def adoption_conflicts(plan: DataFrame) -> DataFrame:
    """Remote records claimed by more than one article."""
    return plan.filter("remote_id IS NOT NULL").groupBy("remote_id").agg(F.count("*").alias("claims")).filter("claims > 1")


def article_url_map(articles: DataFrame, state: DataFrame, remotes: DataFrame) -> DataFrame:
    """Article file name -> address: state portal address, else remote (slug, title), else source.

    ``articles``: id, slug, title, path, source_url; rows without any address are dropped.
    """
    slugs = remotes.filter("coalesce(permalink, '') <> ''").select(F.col("permalink").alias("slug"), F.col("portal_url").alias("_s"), F.lit(True).alias("_hit"), "seq")
    titles = remotes.filter("coalesce(remote_title, '') <> ''").select(_folded(F.col("remote_title")).alias("_t"), F.col("portal_url").alias("_u"), "seq")
    rows = (
        articles.withColumn("_t", _folded(F.col("title")))
        .join(state.select("id", F.col("portal_url").alias("_p")), "id", "left")
        .join(last_wins(slugs, "slug", "seq").drop("seq"), "slug", "left")
        .join(last_wins(titles, "_t", "seq").drop("seq"), "_t", "left")
    )
    remote = F.when(F.col("_hit"), F.col("_s")).otherwise(F.col("_u"))
    url = T.first_filled(F.col("_p"), remote, F.col("source_url"))
    return rows.select("id", T.base_name(F.col("path")).alias("filename"), url.alias("url")).filter("url IS NOT NULL")


TARGET = H.ANCHOR_OR_IMAGE_OPEN


def _with_value(rows: DataFrame) -> DataFrame:
    tag = F.lower(F.regexp_extract("tok", r"\A<([a-zA-Z]+)", 1))
    value = F.when(tag == "img", H.attribute(F.col("tok"), "src")).otherwise(H.attribute(F.col("tok"), "href"))
    return rows.withColumn("tag", tag).withColumn("value", value)


def _set_value(new: Column) -> Column:
    value = H.escape_attribute(new)
    changed = F.when(F.col("tag") == "img", H.set_attribute(F.col("tok"), "src", value)).otherwise(H.set_attribute(F.col("tok"), "href", value))
    return F.when(new.isNotNull(), changed)


def rewrite_bundle_links(
    articles: DataFrame, article_paths: DataFrame, asset_paths: DataFrame, *,
    key: str = "id", body: str = "body", knowledge_scheme: str = "knowledge", asset_scheme: str = "asset",
) -> tuple[DataFrame, DataFrame]:
    """Canonical references become bundle paths; misses stay in place and are issues.

    ``article_paths`` and ``asset_paths`` have (target_id, path). Returns the
    documents and the issue rows (key, pos, issue).
    """
    paths = article_paths.select(F.lit(knowledge_scheme).alias("_scheme"), "target_id", "path").unionByName(
        asset_paths.select(F.lit(asset_scheme).alias("_scheme"), "target_id", F.concat(F.lit("../assets/"), "path").alias("path"))
    )
    pattern = rf"(?s)\A({knowledge_scheme}|{asset_scheme})://([^#]+)(#.*)?\z"

    def resolve(rows: DataFrame) -> DataFrame:
        rows = _with_value(rows)
        for i, name in ((1, "_scheme"), (2, "target_id"), (3, "_anchor")):
            rows = rows.withColumn(name, F.regexp_extract("value", pattern, i))
        rows = rows.filter("_scheme <> ''").join(paths, ["_scheme", "target_id"], "left").unionByName(
            rows.filter("_scheme = ''").withColumn("path", F.lit(None).cast("string"))
        )
        kind = F.when(F.col("_scheme") == knowledge_scheme, "knowledge").otherwise("asset")
        issue = F.when(
            (F.col("_scheme") != "") & F.col("path").isNull(), F.concat(F.lit("unresolved "), kind, F.lit(" link "), "target_id")
        )
        return rows.withColumn("issue", issue).withColumn("replacement", _set_value(F.concat("path", "_anchor")))

    done, rows = rewrite(articles, key, body, TARGET, resolve)
    return done, rows.filter("issue IS NOT NULL").select(key, "pos", "issue")


def _is_local_article(value: Column) -> Column:
    clean = T.without_fragment(value)
    outside = T.is_absolute(clean) | clean.startswith("mailto:")
    return ~outside & T.base_name(clean).endswith(".html")


def rewrite_answer_links(articles: DataFrame, article_urls: DataFrame, asset_urls: DataFrame, *, key: str = "id", body: str = "body") -> tuple[DataFrame, DataFrame]:
    """Bundle-local links become final addresses, fragments kept.

    ``article_urls``: filename, url; ``asset_urls``: key, filename, asset_url.
    Returns documents and unresolved local links, which must fail their article.
    """
    def resolve(rows: DataFrame) -> DataFrame:
        rows = _with_value(rows)
        clean = T.without_fragment(F.col("value"))
        is_asset = clean.startswith("../assets/")
        rows = rows.withColumn("filename", T.base_name(clean)).withColumn(
            "local", F.when(is_asset, "asset").when(_is_local_article(F.col("value")), "article").otherwise("")
        )
        outside = rows.filter("local = ''")
        inside = (
            rows.filter("local <> ''")
            .join(article_urls.select("filename", "url"), "filename", "left")
            .join(asset_urls.select(key, "filename", "asset_url"), [key, "filename"], "left")
        )
        chosen = T.empty_to_null(F.when(F.col("local") == "asset", F.col("asset_url")).otherwise(F.col("url")))
        inside = inside.withColumn("chosen", chosen).drop("url", "asset_url")
        rows = inside.unionByName(outside.withColumn("chosen", F.lit(None).cast("string")))
        return rows.withColumn("replacement", _set_value(F.concat("chosen", T.fragment(F.col("value")))))

    done, rows = rewrite(articles, key, body, TARGET, resolve)
    missed = rows.filter("local <> '' AND chosen IS NULL").select(key, F.col("value").alias("link")).distinct()
    return done, missed


def required_assets(answers: DataFrame, assets: DataFrame, *, key: str = "id", body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(article, file, kind) of referenced bundle assets, and references the bundle lacks."""
    found = targets(answers, key, F.col(body)).filter(F.col("value").startswith("../assets/"))
    named = found.select(key, "pos", "tag", T.base_name(T.without_fragment(F.col("value"))).alias("filename"))
    unique = last_wins(named, [key, "filename"], "pos").drop("pos")
    known = assets.select("filename", "asset_id", "size_bytes")
    return unique.join(known, "filename"), unique.join(known, "filename", "left_anti")


def inline_smallest(required: DataFrame, limit: int = T.ATTACHMENT_LIMIT) -> DataFrame:
    """Over the attachment limit, the smallest images are embedded instead of attached.

    ``required``: article_id, asset_id, filename, size_bytes, kind. Adds ``placed``:
    attached, inlined, or failed when an article has too few images to embed.
    """
    image = (F.col("kind") == "img") & F.coalesce(T.media_type(F.col("filename"), None).startswith("image/"), F.lit(False))
    marked = required.withColumn("_image", image)
    need = marked.groupBy("article_id").agg(
        F.greatest(F.count("*") - limit, F.lit(0)).alias("_k"), F.count_if("_image").alias("_images")
    )
    rows = marked.join(need, "article_id")
    ranked = numbered(rows.filter("_image AND _k > 0"), ["size_bytes", "filename", "asset_id"], ["article_id"], "_rank")
    rest = rows.filter("NOT _image OR _k <= 0").withColumn("_rank", F.lit(None).cast("bigint"))
    placed = (
        F.when(F.col("_images") < F.col("_k"), "failed")
        .when(F.col("_rank") <= F.col("_k"), "inlined")
        .otherwise("attached")
    )
    return ranked.unionByName(rest).withColumn("placed", placed).drop("_k", "_images", "_rank", "_image")


def stale_attachments(remote: DataFrame, managed: DataFrame, required: DataFrame, inlined: DataFrame) -> DataFrame:
    """Managed files at the destination that are neither required nor inlined any more.

    ``remote``, ``required``, ``inlined``: article_id, name; ``managed``: name.
    """
    keys = ["article_id", "name"]
    return (
        remote.join(managed.select("name").distinct(), "name", "left_semi")
        .join(required.select(*keys), keys, "left_anti")
        .join(inlined.select(*keys), keys, "left_anti")
    )


def attachment_plan(required: DataFrame, saved: DataFrame, remote: DataFrame, *, asset_base_url: str | None = None, upload: bool = True) -> DataFrame:
    """linked / reused / adopted / uploaded / refused per required attachment.

    ``required``: article_id, asset_id, filename, upload_name, sha256; ``saved``:
    article_id, asset_id, sha256, url; ``remote``: article_id, name, url.
    """
    if asset_base_url:
        return required.withColumn("action", F.lit("linked")).withColumn(
            "url", F.concat(F.lit(asset_base_url.rstrip("/") + "/"), "filename")
        )
    if not upload:
        return required.withColumn("action", F.lit("refused")).withColumn("url", F.lit(None).cast("string"))
    held = saved.select("article_id", "asset_id", F.col("sha256").alias("_sha"), F.col("url").alias("_saved"))
    there = remote.select("article_id", F.col("name").alias("upload_name"), F.lit(True).alias("_there"), F.col("url").alias("_remote"))
    rows = required.join(held, ["article_id", "asset_id"], "left").join(there, ["article_id", "upload_name"], "left")
    reuse = (F.col("_sha") == F.col("sha256")) & (F.coalesce("_saved", F.lit("")) != "")
    action = F.when(F.coalesce(reuse, F.lit(False)), "reused").when(F.col("_there"), "adopted").otherwise("uploaded")
    url = F.when(action == "reused", F.col("_saved")).when(action == "adopted", F.col("_remote"))
    return rows.withColumn("action", action).withColumn("url", url).drop("_sha", "_saved", "_there", "_remote")


def normalize_attachment(payload: Column) -> Column:
    """resource_id, url, view_url, download_url and name out of a response VARIANT."""
    def unwrap(v: Column, name: str) -> Column:
        return F.coalesce(F.try_variant_get(v, f"$.{name}", "variant"), v)

    inner = unwrap(unwrap(payload, "data"), "attachments")
    first = F.when(
        F.schema_of_variant(inner).startswith("ARRAY"), F.try_variant_get(inner, "$[0]", "variant")
    ).otherwise(inner)
    get = lambda k: T.empty_to_null(F.try_variant_get(first, f"$.{k}", "string"))
    return F.struct(
        F.coalesce(get("resourceId"), get("id")).alias("resource_id"),
        F.coalesce(get("url"), get("viewUrl"), get("downloadUrl"), get("href")).alias("url"),
        get("viewUrl").alias("view_url"), get("downloadUrl").alias("download_url"), get("name").alias("name"),
    )


def article_payload(category_id: Column, status: str, permission: str, locale: str | None = None) -> Column:
    """Request body of an article; the locale is sent on creation only."""
    fields = [
        F.col("title"), F.col("answer"), category_id.alias("categoryId"), F.lit(status).alias("status"),
        F.lit(permission).alias("permission"), F.col("slug").alias("permalink"), F.col("tags"),
    ]
    if locale:
        fields.append(F.lit(locale).alias("locale"))
    return F.to_json(F.struct(*fields))


def bundle_check(manifest: DataFrame, canonical: DataFrame) -> DataFrame:
    """Manifest entries without a canonical object."""
    return manifest.select("id").join(canonical.select("id"), "id", "left_anti")


def manifest_reconcile(manifest: DataFrame, objects: DataFrame) -> DataFrame:
    """left_only / right_only / both per id of manifest and objects."""
    m = manifest.select("id").distinct().withColumn("_m", F.lit(True))
    o = objects.select("id").distinct().withColumn("_o", F.lit(True))
    side = F.when(F.col("_o").isNull(), "left_only").when(F.col("_m").isNull(), "right_only").otherwise("both")
    return m.join(o, "id", "full_outer").select("id", side.alias("side"))


def state_guard(state: DataFrame, category_id: str) -> DataFrame:
    """State rows written for another destination category."""
    return state.filter(~F.col("category_id").eqNullSafe(category_id))


def import_totals(plan: DataFrame) -> DataFrame:
    return plan.agg(
        F.count("*").alias("article_count"),
        *[F.count_if(F.col("action") == a).alias(a) for a in ("created", "updated", "skipped")],
    )


def publish_ledger(plan: DataFrame, failures: DataFrame) -> DataFrame:
    """Outcome counts: every attempt, and created, updated, skipped or failed."""
    failed = failures.select("id").distinct().withColumn("_failed", F.lit(True))
    outcome = F.when(F.col("_failed"), "failed").otherwise(F.col("action"))
    rows = plan.join(failed, "id", "left").select(F.explode(F.array(outcome, F.lit("attempted"))).alias("outcome"))
    return rows.groupBy("outcome").agg(F.count("*").alias("articles"))


def id_map(articles: DataFrame, state: DataFrame) -> DataFrame:
    """Canonical id, source id and destination id side by side."""
    return articles.select("id", "connector", "external_id").join(
        state.select("id", F.col("remote_id").alias("destination_id"), "category_id"), "id", "left"
    )
