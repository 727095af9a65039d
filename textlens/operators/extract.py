"""Platform extractors E1-E3: raw post+comments envelopes -> one nested schema.

Each extractor is a pure column expression over the parsed VARIANT payload
(U1: a registry ``platform -> (payload, extracted_at) -> (post, error)``),
so all three platforms run in one projection of one scan -- no per-row
Python.  ``error`` names the first required field that is missing or
unparsable; one bad comment fails the whole document (I2), which then goes
to quarantine instead of failing a task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlens.functions.jsonpath import (as_str, count_or_zero, first_truthy_node, iso_instant,
                                         node, present, python_int, truthy, unix_seconds, x_time)

COMMENT_FIELDS = ("platform_comment_id", "author_handle", "content", "like_count", "published_at",
                  "sentiment", "sentiment_score", "model_version", "raw_payload")
POST_FIELDS = ("platform", "platform_post_id", "author_handle", "author_name", "content", "url",
               "like_count", "comment_count", "share_count", "view_count", "published_at",
               "crawled_at", "sentiment", "sentiment_score", "model_version", "raw_payload",
               "comments")

Extractor = Callable[[Column, Column], tuple[Column, Column]]


def or_chain(*options: tuple[Column, str], default: Column | None = None) -> Column:
    """``a.x or b.y or default`` across documents (each option = (node, path))."""
    out = None
    for v, p in options:
        val = as_str(v, p)
        out = F.when(truthy(v, p), val) if out is None else out.when(truthy(v, p), val)
    d = default if default is not None else F.lit(None).cast("string")
    return out.otherwise(d)


def _no_scores():
    return (F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("string"))


def comment_struct(cid, handle, content, likes, published, raw) -> Column:
    s, sc, mv = _no_scores()
    vals = (cid, handle, content, likes, published, s, sc, mv, F.to_json(raw))
    return F.struct(*[v.alias(n) for v, n in zip(vals, COMMENT_FIELDS)])


def post_struct(platform, pid, handle, name, content, url, likes, ncom, shares, views,
                published, crawled, raw, comments) -> dict[str, Column]:
    """The post's fields as separate columns (assembled into a struct by
    ``extract``: one CASE per field keeps every field evaluated once)."""
    s, sc, mv = _no_scores()
    vals = (F.lit(platform), pid, handle, name, content, url, likes, ncom, shares, views,
            published, crawled, s, sc, mv, F.to_json(raw), comments)
    return dict(zip(POST_FIELDS, vals))


def _comments(doc: Column) -> Column:
    """The comments array (absent or null = empty)."""
    arr = F.try_variant_get(doc, "$.comments", "array<variant>")
    return F.coalesce(arr, F.array().cast("array<variant>"))


def _not_a_list(doc: Column) -> Column:
    """A truthy ``comments`` that is no array cannot be read as one."""
    return truthy(doc, "$.comments") & F.try_variant_get(doc, "$.comments", "array<variant>").isNull()


def _first_error(checks: list[tuple[Column, str]]) -> Column:
    out = None
    for failed, code in checks:
        out = F.when(failed, F.lit(code)) if out is None else out.when(failed, F.lit(code))
    return out.otherwise(F.lit(None).cast("string"))


def _comment_errors(doc: Column, check: Callable[[Column], Column]) -> Column:
    errs = F.transform(_comments(doc), lambda c, i: F.when(
        check(c).isNotNull(), F.concat(F.lit("comments["), i.cast("string"), F.lit("]."), check(c))))
    return F.try_element_at(F.filter(errs, lambda e: e.isNotNull()), F.lit(1))


def _assemble(doc: Column, crawled: Column, post_checks, comment_check, build_post) -> tuple[Column, Column]:
    p = node(doc, "$.post")
    checks = [(doc.isNull(), "bad_json"), (~present(doc, "$.post"), "missing:post"),
              (crawled.isNull(), "bad:extracted_at"), (_not_a_list(doc), "bad:comments")] + post_checks(p)
    err = _first_error(checks)
    err = F.coalesce(err, _comment_errors(doc, comment_check))
    return build_post(p), err


# --- E2 Instagram --------------------------------------------------------------

def extract_instagram(doc: Column, extracted_at: Column) -> tuple[Column, Column]:
    crawled = iso_instant(extracted_at)

    def checks(p):
        pid_missing = ~truthy(p, "$.pk") & ~present(p, "$.id")
        return [(pid_missing, "missing:post.id"), (unix_seconds(p, "$.taken_at").isNull(), "bad:post.taken_at")]

    def comment_check(c):
        ts = F.when(truthy(c, "$.created_at_utc"), unix_seconds(c, "$.created_at_utc")) \
              .otherwise(unix_seconds(c, "$.created_at"))
        return _first_error([(~present(c, "$.pk"), "missing:pk"), (ts.isNull(), "bad:created_at")])

    def comment(c):
        user = first_truthy_node(c, "$.user")
        ts = F.when(truthy(c, "$.created_at_utc"), unix_seconds(c, "$.created_at_utc")) \
              .otherwise(unix_seconds(c, "$.created_at"))
        return comment_struct(as_str(c, "$.pk"), as_str(user, "$.username"),
                              or_chain((c, "$.text"), default=F.lit("")),
                              count_or_zero(c, "$.comment_like_count"), ts, c)

    def build(p):
        owner = first_truthy_node(p, "$.owner", "$.user")
        caption = first_truthy_node(p, "$.caption")
        pid = F.when(truthy(p, "$.pk"), as_str(p, "$.pk")).otherwise(as_str(p, "$.id"))
        code = as_str(p, "$.code")
        url = F.when(truthy(p, "$.code"), F.concat(F.lit("https://www.instagram.com/p/"), code, F.lit("/")))
        return post_struct("instagram", pid, as_str(owner, "$.username"), as_str(owner, "$.full_name"),
                           or_chain((caption, "$.text"), (p, "$.accessibility_caption"), default=F.lit("")),
                           url, count_or_zero(p, "$.like_count"), count_or_zero(p, "$.comment_count"),
                           F.lit(0).cast("bigint"), F.lit(0).cast("bigint"),
                           unix_seconds(p, "$.taken_at"), crawled, p,
                           F.transform(_comments(doc), comment))

    return _assemble(doc, crawled, checks, comment_check, build)


# --- E3 TikTok -----------------------------------------------------------------

def extract_tiktok(doc: Column, extracted_at: Column) -> tuple[Column, Column]:
    crawled = iso_instant(extracted_at)

    def checks(p):
        return [(~present(p, "$.id"), "missing:post.id"),
                (unix_seconds(p, "$.createTime").isNull(), "bad:post.createTime")]

    def comment_check(c):
        return _first_error([(~present(c, "$.cid"), "missing:cid"),
                             (unix_seconds(c, "$.create_time").isNull(), "bad:create_time")])

    def comment(c):
        user = first_truthy_node(c, "$.user")
        return comment_struct(as_str(c, "$.cid"),
                              or_chain((user, "$.uniqueId"), (user, "$.nickname")),
                              or_chain((c, "$.text"), default=F.lit("")),
                              count_or_zero(c, "$.digg_count"), unix_seconds(c, "$.create_time"), c)

    def build(p):
        author = first_truthy_node(p, "$.author")
        stats = first_truthy_node(p, "$.stats")
        uid = as_str(author, "$.uniqueId")
        pid = as_str(p, "$.id")
        url = F.when(truthy(author, "$.uniqueId"),
                     F.concat(F.lit("https://www.tiktok.com/@"), uid, F.lit("/video/"), pid))
        return post_struct("tiktok", pid, uid, as_str(author, "$.nickname"),
                           or_chain((p, "$.desc"), default=F.lit("")), url,
                           count_or_zero(stats, "$.diggCount"), count_or_zero(stats, "$.commentCount"),
                           count_or_zero(stats, "$.shareCount"), count_or_zero(stats, "$.playCount"),
                           unix_seconds(p, "$.createTime"), crawled, p,
                           F.transform(_comments(doc), comment))

    return _assemble(doc, crawled, checks, comment_check, build)


# --- E1 X ----------------------------------------------------------------------

def _x_text(t: Column) -> Column:
    """Long-form note text wins over the (truncated) legacy full text."""
    return or_chain((t, "$.note_tweet.note_tweet_results.result.text"), (t, "$.legacy.full_text"),
                    default=F.lit(""))


def _x_author(t: Column) -> tuple[Column, Column]:
    user = node(t, "$.core.user_results.result")
    handle = or_chain((user, "$.core.screen_name"), (user, "$.legacy.screen_name"))
    name = or_chain((user, "$.core.name"), (user, "$.legacy.name"))
    return handle, name


def _x_id(t: Column) -> Column:
    return F.when(truthy(t, "$.legacy.id_str"), as_str(t, "$.legacy.id_str")).otherwise(as_str(t, "$.rest_id"))


def _x_id_missing(t: Column) -> Column:
    return ~truthy(t, "$.legacy.id_str") & ~present(t, "$.rest_id")


def extract_x(doc: Column, extracted_at: Column) -> tuple[Column, Column]:
    crawled = iso_instant(extracted_at)

    def checks(p):
        return [(_x_id_missing(p), "missing:post.rest_id"),
                (x_time(as_str(p, "$.legacy.created_at")).isNull(), "bad:post.legacy.created_at")]

    def comment_check(c):
        return _first_error([(_x_id_missing(c), "missing:rest_id"),
                             (x_time(as_str(c, "$.legacy.created_at")).isNull(), "bad:legacy.created_at")])

    def comment(c):
        handle, _ = _x_author(c)
        return comment_struct(_x_id(c), handle, _x_text(c), count_or_zero(c, "$.legacy.favorite_count"),
                              x_time(as_str(c, "$.legacy.created_at")), c)

    def build(p):
        handle, name = _x_author(p)
        pid = _x_id(p)
        url = F.when(handle.isNotNull() & (handle != ""),
                     F.concat(F.lit("https://x.com/"), handle, F.lit("/status/"), pid))
        shares = count_or_zero(p, "$.legacy.retweet_count") + count_or_zero(p, "$.legacy.quote_count")
        # int(views.count or 0), and 0 when int() would raise
        views = F.when(truthy(p, "$.views.count"),
                       F.coalesce(python_int(p, "$.views.count"), F.lit(0).cast("bigint"))) \
                 .otherwise(F.lit(0).cast("bigint"))
        return post_struct("x", pid, handle, name, _x_text(p), url,
                           count_or_zero(p, "$.legacy.favorite_count"),
                           count_or_zero(p, "$.legacy.reply_count"), shares, views,
                           x_time(as_str(p, "$.legacy.created_at")), crawled, p,
                           F.transform(_comments(doc), comment))

    return _assemble(doc, crawled, checks, comment_check, build)


# The extractor registry (platform -> column builder)
EXTRACTORS: dict[str, Extractor] = {
    "instagram": extract_instagram,
    "tiktok": extract_tiktok,
    "x": extract_x,
}


def parse_payload(raw: Column) -> Column:
    """Envelope payload as VARIANT (already VARIANT, or JSON text)."""
    return F.try_parse_json(raw)


def extract(envelopes: DataFrame, payload: str = "raw_payload", platform: str = "platform",
            extracted_at: str = "extracted_at", extractors: dict[str, Extractor] | None = None,
            keep: tuple[str, ...] = ()) -> DataFrame:
    """J8 dispatch: ``keep..., platform, batch_id, post, error`` for every envelope.

    One ``CASE platform`` per output column; unknown platforms get an error.
    """
    ex = extractors or EXTRACTORS
    doc = parse_payload(F.col(payload)) if dict(envelopes.dtypes)[payload] != "variant" else F.col(payload)
    env = envelopes.withColumn("_doc", doc)
    fields: dict[str, Column] = {}
    err = None
    for name, fn in ex.items():
        p, e = fn(F.col("_doc"), F.col(extracted_at))
        cond = F.col(platform) == name
        for f in POST_FIELDS:
            fields[f] = F.when(cond, p[f]) if f not in fields else fields[f].when(cond, p[f])
        err = F.when(cond, e) if err is None else err.when(cond, e)
    err = err.otherwise(F.concat(F.lit("unknown platform: "), F.coalesce(F.col(platform), F.lit("null"))))
    flat = env.select(*keep, platform, "batch_id", *[c.alias(f"_p_{f}") for f, c in fields.items()],
                      err.alias("error"))
    post = F.struct(*[F.col(f"_p_{f}").alias(f) for f in POST_FIELDS])
    return flat.select(*keep, platform, "batch_id", post.alias("post"), "error")


def valid_posts(extracted: DataFrame) -> DataFrame:
    return extracted.filter(F.col("error").isNull())


def failures(extracted: DataFrame) -> DataFrame:
    return extracted.filter(F.col("error").isNotNull()).drop("post")


def to_payload(post: Column) -> Column:
    """The whole normalised record as JSON (ISO-8601 times with
    '+00:00', comments nested, raw sub-documents kept as JSON values)."""
    from textlens.functions.jsonpath import iso_text
    comments = F.transform(post["comments"], lambda c: F.struct(
        *[(iso_text(c[f]) if f == "published_at"
           else F.try_parse_json(c[f]) if f == "raw_payload" else c[f]).alias(f)
          for f in COMMENT_FIELDS]))
    fields = []
    for f in POST_FIELDS:
        if f in ("published_at", "crawled_at"):
            fields.append(iso_text(post[f]).alias(f))
        elif f == "raw_payload":
            fields.append(F.try_parse_json(post[f]).alias(f))
        elif f == "comments":
            fields.append(comments.alias(f))
        else:
            fields.append(post[f].alias(f))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
