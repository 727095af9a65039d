"""E1-E3 fallbacks (FIXTURES §4): absent / null / '' / 0, comment rules."""

import json

from textlens.operators.extract import extract

AT = "2024-01-01T00:00:00Z"


def run(spark, platform, payload):
    raw = payload if isinstance(payload, str) else json.dumps(payload)
    df = spark.createDataFrame([(platform, "b1", "pending", AT, raw)],
                               "platform string, batch_id string, status string, extracted_at string, raw_payload string")
    return extract(df).first()


def test_instagram_fallbacks(spark):
    r = run(spark, "instagram", {"post": {"pk": 0, "id": 77, "taken_at": "1700000000",
                                          "caption": None, "accessibility_caption": "alt",
                                          "owner": {}, "user": {"username": "u", "full_name": "U"},
                                          "like_count": None, "code": ""},
                                 "comments": [{"pk": 5, "text": "", "created_at_utc": 0, "created_at": 1700000001}]})
    p = r.post
    assert r.error is None
    assert (p.platform_post_id, p.content, p.author_handle, p.author_name, p.url, p.like_count) == \
           ("77", "alt", "u", "U", None, 0)
    c = p.comments[0]
    assert (c.platform_comment_id, c.content, c.published_at.timestamp()) == ("5", "", 1700000001)


def test_tiktok_nickname_fallback_and_missing_time(spark):
    r = run(spark, "tiktok", {"post": {"id": "9", "createTime": 1700000000, "author": {"uniqueId": "me"},
                                       "stats": {"playCount": "12"}},
                              "comments": [{"cid": "c1", "create_time": 1700000002,
                                            "user": {"uniqueId": None, "nickname": "nick"}}]})
    assert r.error is None and r.post.comments[0].author_handle == "nick"
    assert r.post.url == "https://www.tiktok.com/@me/video/9" and r.post.view_count == 12
    bad = run(spark, "tiktok", {"post": {"id": "9"}})
    assert bad.error == "bad:post.createTime"


def test_x_note_text_views_and_bad_comment(spark):
    node = {"rest_id": "1", "legacy": {"id_str": "", "full_text": "short", "created_at": "Sat Jul 25 18:26:52 +0000 2026",
                                       "retweet_count": 2, "quote_count": None},
            "note_tweet": {"note_tweet_results": {"result": {"text": "long form"}}},
            "core": {"user_results": {"result": {"core": {}, "legacy": {"screen_name": "h", "name": "N"}}}},
            "views": {"count": "abc"}}
    r = run(spark, "x", {"post": node, "comments": []})
    p = r.post
    assert r.error is None
    assert (p.platform_post_id, p.content, p.author_handle, p.author_name, p.view_count, p.share_count) == \
           ("1", "long form", "h", "N", 0, 2)
    assert p.url == "https://x.com/h/status/1"
    bad = run(spark, "x", {"post": node, "comments": [{"legacy": {"id_str": "2", "created_at": "nope"}}]})
    assert bad.error == "comments[0].bad:legacy.created_at"


def test_bad_json_and_missing_post(spark):
    assert run(spark, "x", "{not json").error == "bad_json"
    assert run(spark, "instagram", {"comments": []}).error == "missing:post"
    assert run(spark, "mastodon", {"post": {}}).error == "unknown platform: mastodon"


def test_x_view_count_like_python_int(spark):
    base = {"rest_id": "1", "legacy": {"created_at": "Sat Jul 25 18:26:52 +0000 2026"}}
    for count, want in ((12.7, 12), ("12", 12), ("12.7", 0), (None, 0), ("", 0), ("-3", -3)):
        node = dict(base, views={"count": count})
        assert run(spark, "x", {"post": node}).post.view_count == want, count
