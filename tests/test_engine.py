"""The engine's operators: stated vectors, round trips, idempotence, and the distributed rules against sequential ones."""

from __future__ import annotations

import json
import random
import uuid
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark import cli, config
from tidemark.config import Config
from tidemark.functions import ids, parse, text, urls
from tidemark.operators import classify, dedup, emit, enrich, relational, scoring, store
from tidemark.plans import cleaning, scheduler
from tidemark.plans.pipeline import Engine
from tidemark.sources import hotsearch, jsonl, tasks
from tidemark.streaming import incremental


def values(spark, rows, f, kind="string"):
    df = spark.createDataFrame([(k, x) for k, x in enumerate(rows)], f"k int, x {kind}")
    return [r[0] for r in df.orderBy("k").select(f(F.col("x"))).collect()]


# ---- functions ----
def test_normalize(spark):
    rows = ["ＡＢＣ  Straße!!", None, "a_b--c", "火灾！ 2,301", "  "]
    want = ["abc strasse", "", "a b c", "火灾 2 301", ""]
    assert values(spark, rows, text.normalize_text) == want


def test_simhash_forms_agree(spark):
    rows = ["", "a", "ab cd", "the quick brown fox", "火灾 爆炸", "the the the quick the"]
    assert values(spark, rows, text.simhash64) == values(spark, rows, text.simhash64_arrow) == [text.simhash_py(x) for x in rows]


def test_ratio_is_asymmetric():
    assert text.ratio("tide", "diet") == 0.25 and text.ratio("diet", "tide") == 0.5 and text.ratio("", "x") == 0.0


def test_redaction(spark):
    rows = ["call 13812345678 or +86 13912345678", "no 138123456789", "id 11010519491231002X", None]
    assert values(spark, rows, text.redact_pii) == ["call [手机号] or [手机号]", "no 138123456789", "id [身份证号]", None]
    beside = ["ID110101199003071234", "x11010119900307123Xy", "111010119900307123X", "110101199013071234", "n=11010119900307123x5"]
    assert values(spark, beside, text.redact_pii) == ["ID[身份证号]", "x[身份证号]y", *beside[2:]]
    assert [text.redact_value(x) for x in beside] == values(spark, beside, text.redact_pii)
    assert text.redact_value({"author_id": "u1", "x": [{"note": "13812345678"}], "n": 1}) == {"author_id": "***", "x": [{"note": "[手机号]"}], "n": 1}


@pytest.mark.parametrize(
    ("url", "want"),
    [
        ("HTTPS://Example.COM:443/a/../b/?b=2&xsec_token=q&a=1#x", "https://example.com/b?a=1&b=2"),
        ("http://u:p@h.com:8080//x/./y/?k&UTM_Source=1", "http://h.com:8080/x/y?k="),
        ("http://h.com", "http://h.com/"), ("http://h.com:99999/", None), ("http://h.com:ab/", None), ("javascript:alert(1)", None), ("ftp://h.com/", None), ("", None), (None, None), ("http:///x", None),
        ("http://[2001:DB8::1]:80/a", "http://[2001:db8::1]/a"), ("http://h.com/../../a/..", "http://h.com/"),
    ],
)
def test_canonical_url(spark, url, want):
    assert values(spark, [url], urls.canonicalize_url) == [want]


def test_public_url():
    at = lambda a: lambda h: [a]
    assert urls.public_url("https://x.com/", at("93.184.216.34"))
    for a in ("127.0.0.1", "10.0.0.1", "169.254.1.1", "::1", "0.0.0.0", "224.0.0.1"):
        assert not urls.public_url("https://x.com/", at(a))
    assert not urls.public_url("file:///etc/passwd", at("93.184.216.34"))
    assert urls.joined("http://a/b/", "javascript:x") is None and urls.joined("http://a/b/", "../c") == "http://a/c"


def test_uuid5(spark):
    assert values(spark, ["a", "火灾", ""], lambda c: ids.uuid5(ids.NS_RAW, c)) == [str(uuid.uuid5(ids.NS_RAW, x)) for x in ("a", "火灾", "")]


def test_parsers(spark):
    assert values(spark, ["8.9万", "2,301", "456万", "1亿", "-3", "x", None, "12 345", ""], parse.parse_count) == [89000, 2301, 4560000, 100000000, None, None, None, 12345, None]
    assert values(spark, ["12,345", "1.2万", "7", "-1", None], parse.as_int) == [12345, None, 7, None, None]
    got = values(spark, ["1704067200", "1704067200000", "2024-01-01T08:00:00+08:00", "2024-01-01T00:00:00Z", "2024-01-01", "soon", None, "20261008"], lambda c: F.date_format(parse.parse_datetime(c), "yyyy-MM-dd HH"))
    assert got == ["2024-01-01 00"] * 5 + [None, None, "1970-08-23 12"]
    assert values(spark, ["level_3", "urgent"], lambda c: parse.level_number(c, F.lit(9))) == [3, 9]
    assert values(spark, ['```json\n{"a":1}\n```', ' {"a":1} '], parse.fenced_json) == ['{"a":1}', '{"a":1}']


# ---- classification and scoring ----
def test_classify(spark):
    df = spark.createDataFrame([(1, "某地发生火灾和爆炸", "火灾"), (2, "天气很好", None), (3, "拆迁 拆迁 聚集", None)], "id int, title string, keyword string")
    rules = {k: (c.weight, c.keywords) for k, c in Config().rules.items()} | {"other": (200.0, ["！"])}
    got = {r.id: r for r in classify.classify_items(df, rules).collect()}
    assert (got[1].category, got[1].confidence, got[1].reason) == ("sudden_event", 0.70, "爆炸、火灾")
    assert (got[2].category, got[2].confidence) == ("other", 0.30)
    assert got[3].category == "mass_event"


def test_scores(spark):
    row = ("sudden_event", 0.7, "sudden_event", 0.92, 88.0, 80.0, "keyword_search", None, None, None, 999_999)
    cols = "rule_category string, rule_confidence double, llm_category string, llm_confidence double, risk_score double, sentiment_score double, source_type string, account_config_id string, best_rank int, ranked_platform string, interaction_total long"
    r = scoring.score(spark.createDataFrame([row], cols), Config()).first()
    got = [getattr(r.components, k).score for k in config.COMPONENT_WEIGHTS]
    assert got[0] == 70 and got[1] == 60 and got[2] > 99 and got[3:] == [92, 80, 88]
    assert abs(r.overall_score - 81.9) < 0.1 and r.alert_level == "orange" and not r.requires_manual_review
    hot = spark.createDataFrame([(*row[:5], None, "hotsearch", None, 1, "weibo", 1_000_000)], cols)
    r = scoring.score(hot, Config()).first()
    assert abs(r.components.heat.score - 97) < 1e-6 and r.review_reasons == ["missing_sentiment"]
    half = spark.createDataFrame([(*row[:2], "other", 0.5, 0.0, 0.8, "account", "a", None, None, 0)], cols)
    c = Config()
    c.scoring.account_weights = {"a": 77.0}
    r = scoring.score(half, c).first()
    assert r.components.source.score == 77 and r.components.sentiment.score == 80 and r.components.heat.score == 0 and r.review_reasons == ["low_confidence", "category_conflict"]
    assert scoring.fingerprint(c) != scoring.fingerprint(Config()) and len(scoring.fingerprint(c)) == 12


def test_evidence(spark):
    s = spark.createDataFrame([("c", "r2", 0), ("c", "r1", 1), ("c", "r3", 2)], "clean_item_id string, raw_item_id string, pos int")
    raw = spark.createDataFrame([("r1", "weibo", 1, 5, {"like": 3}, "hotsearch", None), ("r2", "baidu", None, None, {"like": 2, "share": 9}, "account", "a"), ("r3", "zhihu", 4, None, {}, "hotsearch", None)], "id string, platform string, rank int, hot_value long, engagement map<string,long>, source_type string, account_config_id string")
    r = scoring.evidence(s, raw).first()
    assert (r.interaction_total, r.best_rank, r.ranked_platform, r.source_type, r.account_config_id) == (11, 1, "weibo", "account", "a")


# ---- deduplication ----
def items(seed, n):
    r = random.Random(seed)
    base = [" ".join(r.choice(["ba", "do", "ki", "lu", "me", "no", "pi"]) * 2 for _ in range(12)) for _ in range(4)]
    out = []
    for k in range(n):
        w = r.choice(base).split()
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = r.choice(["zu", "wo", "ta"])
        t = " ".join(w[: r.randint(8, 12)])
        out.append({"id": f"i{k:03}", "ord": r.random() if k % 9 else -1 + k / 1000, "anchor": k % 9 == 0, "platform": r.choice("ab"), "external_id": r.choice(["", None, *map(str, range(12))]), "url_hash": r.choice([None, None, *map(str, range(9))]), "norm_title": t[: r.randint(20, 40)], "norm_full": t, "simhash": text.simhash_py(t)})
    return out


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("cross", [True, False])
def test_dedup_equals_sequential(spark, seed, cross):
    rows = items(seed, 70)
    schema = "id string, ord double, anchor boolean, platform string, external_id string, url_hash string, norm_title string, norm_full string, simhash string"
    df = spark.createDataFrame([tuple(x[c.split()[0]] for c in schema.split(", ")) for x in rows], schema)
    got = {r.id: r.duplicate_of for r in dedup.deduplicate(df, cross_platform=cross).collect()}
    # anchors may be alike; they lead from the start
    assert got == dedup.sequential(rows, cross_platform=cross)


RAW = "id string, source_type string, platform string, external_id string, title string, content string, url string, keyword string, published_at timestamp, collected_at timestamp"


def raw(k, title, hours=1, **kw):
    t = datetime(2024, 1, 10)
    x = {"id": f"r{k}", "source_type": "keyword_search", "platform": "xhs", "external_id": f"xhs:{k}", "title": title, "content": None, "url": None, "keyword": "火灾", "published_at": t - timedelta(hours=hours) if hours is not None else None, "collected_at": t} | kw
    return tuple(x[c.split()[0]] for c in RAW.split(", "))


def test_cleaning(spark):
    rows = [
        raw(1, "火灾现场 一号仓库起火", 73), raw(2, "没有时间", None), raw(3, "first", 5, url="https://a.com/x?b=1&a=2&xsec_token=1"), raw(4, "quite another title", 4, url="https://a.com/x/?a=2&b=1&share_token=9"),
        raw(5, "某市发生重大火灾事故造成多人受伤", 3), raw(6, "某市发生重大火灾事故造成多人受伤！", 2),
    ]
    df = spark.createDataFrame(rows, RAW)
    out = cleaning.run(df, None, Config(), F.lit("2024-01-10").cast("timestamp"))
    d = {r.raw_item_id: (r.outcome, r.reason) for r in out.decisions.collect()}
    assert d == {"r1": ("discarded", "expired"), "r2": ("accepted", None), "r3": ("accepted", None), "r4": ("discarded", "duplicate"), "r5": ("accepted", None), "r6": ("discarded", "duplicate")}
    s = relational.with_sources(out.accepted.select(F.col("id").alias("clean_item_id"), F.col("raw_item_id").alias("r")), out.sources).collect()
    assert {x.r: x.source_raw_item_ids for x in s} == {"r2": ["r2"], "r3": ["r3", "r4"], "r5": ["r5", "r6"]}
    assert tuple(out.run.first())[1:] == (6, 3, 3)
    drop = Config()
    drop.processing.missing_published_at = "drop"
    assert cleaning.run(df, None, drop, F.lit("2024-01-10").cast("timestamp")).decisions.where("reason = 'missing_published_at'").count() == 1
    again = cleaning.run(spark.createDataFrame([raw(7, "某市发生重大火灾事故造成多人受伤。", 1)], RAW), out.accepted, Config(), F.lit("2024-01-10").cast("timestamp"))
    assert again.decisions.first().outcome == "discarded" and again.sources.count() == 1


# ---- sources ----
LINES = [
    '{"note_id": "n1", "title": "火灾", "desc": "详情 x", "note_url": "https://a.com/1", "liked_count": "12,345", "comment_count": 67, "publish_time": 1704067200000, "nickname": "u"}', "",
    '{"aweme_id": 5, "display_title": "t2", "digg_count": 45, "url": "ftp://x", "publish_time": "2024-01-01T10:00:00+08:00"}', '{"desc": "' + "x" * 130 + '"}', '{"broken', "[1]", '{"note_id": "z"}',
]


def test_jsonl(spark, tmp_path):
    f = tmp_path / "a" / "search_contents_1.jsonl"
    f.parent.mkdir()
    f.write_text("\n".join(LINES), encoding="utf-8")
    good, bad = jsonl.load_items(spark, str(f), jsonl.Context(keyword="火灾", keyword_level=1))
    g = {r.title[:5]: r for r in good.collect()}
    assert set(g) == {"火灾", "t2", "xxxxx"} and len(g["xxxxx"].title) == 120
    assert g["火灾"].engagement == {"like": 12345, "comment": 67} and g["火灾"].external_id == "xhs:n1" and g["火灾"].url == "https://a.com/1"
    assert g["t2"].url is None and g["t2"].engagement == {"like": 45} and g["t2"].published_at.hour == 2
    assert g["xxxxx"].external_id.startswith("xhs:hash:")
    assert sorted((r.line_number, r.reason) for r in bad.collect()) == [(5, "invalid JSON"), (6, "not an object"), (7, "no title")]
    assert jsonl.load_items(spark, str(f), jsonl.Context(), limit=1)[0].count() == 1
    good, bad = jsonl.load_items(spark, str(tmp_path / "none"), jsonl.Context())
    assert good.count() == 0 and bad.first().reason == "file not found"
    c = tmp_path / "a" / "search_comments_1.jsonl"
    c.write_text('{"comment_id": "c1", "note_id": "n1", "content": "啊", "like_count": "3"}\n{"comment_id": "c2"}\n')
    good, bad = jsonl.load_comments(spark, str(c), jsonl.Context())
    assert good.first().note_external_id == "xhs:n1" and good.first().like_count == 3 and bad.count() == 1
    assert [r.path.rsplit("/", 1)[1] for r in jsonl.discover(spark, str(tmp_path), comments=False).collect()] == [f.name]
    assert jsonl.discover(spark, str(tmp_path), comments=True).count() == 1 and jsonl.discover(spark, str(tmp_path / "no")).count() == 0
    n = jsonl.count_valid(jsonl.read_lines(spark, str(f))).first()
    assert (n.total, n.valid) == (6, 4)


def test_initial_state(spark):
    page = '<script>window.__INITIAL_STATE__={"a":undefined,"b":new Set([]),"c":{"d":[1,NaN]},"e":new Map([])}</script>'
    assert json.loads(values(spark, [page, "<p>", "<script>window.__INITIAL_STATE__={oops}</script>"], lambda c: F.to_json(jsonl.initial_state(c)))[0]) == {"a": None, "b": [], "c": {"d": [1, None]}, "e": {}}


WEIBO = '<table><thead><tr><th>x</th></tr></thead><tbody><tr><td class="td-01">1</td><td class="td-02"><a href="/w?q=1">话题 一</a><span>8.9万</span></td><td class="td-03">热</td></tr><tr><td class="td-02"><a href="javascript:x">二</a></td></tr><tr><td>none</td></tr></tbody></table>'
BAIDU = '<div class="category-wrap_1" data-index="7"><a href="https://b.com/1"><img src=x></a><div class="index_9">1</div><div class="hot-index_3">456万</div><div class="c-single-text-ellipsis"><span class="c-single-text-raw">B1</span></div><div class="hot-desc_1">d</div></div><div class="category-wrap_1" data-index="4"><span class="title_x">B2</span></div>'
ZHIHU = '<script id="js-initialData" type="text/json">{"initialState":{"topstory":{"hotList":[{"target":{"titleArea":{"text":"Z1"},"link":{"url":"https://z/1"}},"metrics":{"hot":98765}},{"target":{}},{"target":{"titleArea":{"text":"Z3"},"link":{"url":"x"}}}]}}}</script>'
DOUYIN = '{"data":{"word_list":[{"word":"D1","position":2,"hot_value":987654},{"keyword":"D2","position":true},{"x":1}]}}'
BILI = '{"data":{"trending":{"list":[{"keyword":"k","show_name":"S1","heat_score":5,"uri":""},{"name":"N2","score":3}]}}}'
PAGES = {"weibo": WEIBO, "baidu": BAIDU, "zhihu": ZHIHU, "douyin": DOUYIN, "bilibili": BILI}


def test_parsers_of_pages():
    got = {k: [r[:4] for r in hotsearch.parse(k, v, "https://s.com/top/")] for k, v in PAGES.items()}
    assert got["weibo"] == [(1, "话题 一", "https://s.com/w?q=1", "8.9万"), (2, "二", None, None)]
    assert got["baidu"] == [(1, "B1", "https://b.com/1", "456万"), (4, "B2", None, None)]
    assert got["zhihu"] == [(1, "Z1", "https://z/1", "98765"), (3, "Z3", None, None)]
    assert got["douyin"] == [(2, "D1", None, "987654"), (2, "D2", None, None)]
    assert got["bilibili"] == [(1, "S1", None, "5"), (2, "N2", None, "3")]
    for k in PAGES:
        with pytest.raises(hotsearch.ParseError):
            hotsearch.parse(k, "{}" if k in ("douyin", "bilibili") else "<p></p>")
    with pytest.raises(hotsearch.ParseError):
        hotsearch.parse("none", "x")


def test_collect_isolates(spark):
    def fetcher(url):
        for k, u in hotsearch.URLS.items():
            if u == url:
                if k == "zhihu":
                    raise OSError("down")
                return "{}" if k == "bilibili" else PAGES[k]

    items_, outcomes = hotsearch.collect(spark, list(PAGES), "2024-01-01 00:00:00", fetcher)
    o = {r.platform: (r.success, r.item_count) for r in outcomes.collect()}
    assert o == {"weibo": (True, 2), "baidu": (True, 2), "zhihu": (False, 0), "douyin": (True, 2), "bilibili": (False, 0)}
    w = items_.where("platform = 'weibo' and rank = 1").first()
    assert (w.hot_value, w.external_id) == (89000, "weibo:1") and w.id == str(uuid.uuid5(ids.NS_HOT, "weibo:2024-01-01T00:00:00+00:00:1:话题 一"))
    with pytest.raises(ValueError):
        hotsearch.collect(spark, ["nowhere"], "2024-01-01", fetcher)


def test_fetch():
    calls = []

    def transport(replies):
        def get(url, headers, timeout):
            calls.append(url)
            return replies[min(len(calls), len(replies)) - 1]

        return get

    public = lambda h: ["93.184.216.34"]
    go = lambda replies, **k: (calls.clear(), hotsearch.fetch("https://x.com", transport(replies), resolve=public, sleep=lambda s: None, **k))[1]
    assert go([(503, b""), (200, b"ok")]) == "ok" and len(calls) == 2
    for replies, n in (([(404, b"")], 1), ([(500, b"")], 3), ([(200, b" ")], 1)):
        with pytest.raises(hotsearch.FetchError):
            go(replies)
        assert len(calls) == n
    with pytest.raises(hotsearch.FetchError):
        hotsearch.fetch("https://x.com", transport([(200, b"x")]), resolve=lambda h: ["127.0.0.1"])


def test_tasks(spark):
    c = Config()
    c.collect.keyword_levels, c.collect.accounts, c.collect.crawl_platforms = {"level_2": ["a", "b"], "urgent": ["c"]}, {"acc": "wb"}, ["xhs", "dy"]
    rows = tasks.from_config(spark, c).collect()
    assert len(rows) == 7 and len({r.task_id for r in rows}) == 7
    assert {(r.target, r.level) for r in rows} == {("a", 2), ("b", 2), ("c", 2), ("acc", None)}
    assert tasks.command({"source_type": "account", "target": "x; rm", "platform": "wb"})[6:8] == ["--creator_id", "x; rm"]


# ---- storage ----
def test_store(spark, tmp_path):
    s = store.Store(spark, f"file://{tmp_path}/s")
    a = spark.createDataFrame([("1", "x"), ("1", "x"), ("2", "y")], "id string, v string")
    assert s.append_new("raw_items", a) == 2 and s.append_new("raw_items", a) == 0 and s.read("raw_items").count() == 2
    t = lambda v, c, u: spark.createDataFrame([("e", v, c, u)], "event_id string, v int, created_at int, updated_at int")
    s.upsert("deliveries", t(1, 10, 10))
    s.upsert("deliveries", t(2, 20, 20))
    assert tuple(s.read("deliveries").first()) == ("e", 2, 10, 20)
    s.append("audits", a)
    s.append("audits", a)
    assert s.read("audits").count() == 6 and s.read("nothing") is None
    assert store.orphans(a, a.where("id = '1'"), "id", "id").count() == 1
    assert sorted(tuple(r) for r in store.replace(a, a.where("id = '2'").withColumn("v", F.lit("z")), ["id"]).collect())[-1] == ("2", "z")


# ---- enrichment ----
def test_strict_schemas():
    for f in enrich.schemas(["neutral", "angry"]).values():
        assert enrich.strict_problems(f) == []
    assert len(enrich.strict_problems({"type": "object", "properties": {"a": {"type": "array"}}, "required": []})) == 3
    assert not enrich.conforms({"category": "x", "confidence": 1, "reason": ""}, enrich.schemas(["n"])["classification"])


def test_client():
    form = enrich.schemas(["n"])["risk_assessment"]
    good = json.dumps({"status": "completed", "output": [{"type": "message", "content": [{"type": "output_text", "text": '```json\n{"risk_score": 1, "risk_reason": "r"}\n```'}]}], "usage": {"input_tokens": 5, "output_tokens": 2}})
    replies, sent = [(429, ""), (200, good)], []
    c = enrich.Client(lambda u, h, b: (sent.append(b), replies[min(len(sent), len(replies)) - 1])[1], "http://m", "m", sleep=lambda s: None)
    a = c("risk_assessment", "s", "u", form)
    assert a.data["risk_score"] == 1 and a.usage["total_tokens"] == 7 and a.tries == 2 and sent[0]["text"]["format"]["type"] == "json_schema"
    for body in ({"status": "incomplete"}, {"output": [{"type": "message", "content": [{"type": "refusal"}]}]}, {"output": []}, {"output_text": "[1]"}):
        with pytest.raises(enrich.ClientError):
            enrich.Client(lambda u, h, b: (200, json.dumps(body)), sleep=lambda s: None)("t", "s", "u", form)
    with pytest.raises(enrich.ClientError):
        c("t", "s", "u", {"type": "object"})


def test_analyse(spark):
    it = spark.createDataFrame([("a", "t1"), ("b", "t2"), ("bad", "t3")], "clean_item_id string, title string")
    com = spark.createDataFrame([("a", "1", "hm", 2, None)], "clean_item_id string, id string, content string, like_count long, published_at timestamp")
    reqs = enrich.requests(it, com)
    assert {(r.clean_item_id, r.n) for r in reqs.groupBy("clean_item_id").agg(F.count("*").alias("n")).collect()} == {("a", 4), ("b", 3), ("bad", 3)}

    def client(task, system, user, schema):
        if "t3" in user:
            raise enrich.ClientError("status 500", 3)
        return enrich.stand_in(task, system, user, schema)

    r = {x.clean_item_id: x for x in enrich.analyse(reqs, client, ["neutral", "angry"]).collect()}
    assert r["a"].ok and r["a"].sentiment.dominant in ("neutral", "angry") and r["a"].attempts == 4
    assert r["b"].sentiment.dominant == "unknown" and not r["bad"].ok and r["bad"].error == "status 500" and r["bad"].attempts == 3
    p = enrich.PROMPTS["classification"]
    assert "PAYLOAD" not in enrich.user_part(p, "{}") and enrich.system_part(p).startswith("Classify")


# ---- output ----
def test_post():
    public = lambda h: ["93.184.216.34"]
    replies = [(429, ""), (200, '{"errcode": 0}')]
    n = []
    out = emit.post("https://x.com/h", "{}", lambda u, b, t: (n.append(1), replies[len(n) - 1])[1], resolve=public, sleep=lambda s: None)
    assert out["status"] == "succeeded" and out["http_tries"] == 2
    assert emit.post("https://x.com/h", "{}", lambda u, b, t: (200, '{"errcode": 3}'), resolve=public)["error"] == "errcode"
    assert emit.post("https://x.com/h", "{}", lambda u, b, t: (400, "no"), resolve=public)["http_tries"] == 1
    assert emit.post("https://x.com/h", "{}", lambda u, b, t: (200, ""), resolve=lambda h: ["10.0.0.1"])["http_tries"] == 0
    assert emit.post("", "{}")["status"] == "failed" and emit.post("https://example.invalid/", "{}")["status"] == "failed"


def test_body_problem(spark):
    rows = ["", None, "OK", "<p>", '{"errcode":1}', '{"code":0,"success":true}', '{"status":"Error"}', '{"success":false}']
    want = [None, None, None, "not JSON", "errcode", None, "status", "success"]
    assert values(spark, rows, emit.body_problem) == want == [emit.body_problem_py(x or "") for x in rows]


def test_ledger(spark):
    ev = spark.createDataFrame([("e1", "c1", "c1", "标题 13812345678", "red", 91.5, "other", "原因", None, ["low_confidence"], None)], "event_id string, trace_id string, clean_item_id string, title string, alert_level string, overall_score double, category string, summary string, sentiment_summary string, review_reasons array<string>, url string")
    p = emit.payloads(ev)
    body = json.loads(p.first().payload)
    assert list(body) == sorted(body) and "13812345678" not in p.first().payload and body["score"] == "91.50" and "### 复核\n- low_confidence" in body["markdown"]
    done = spark.createDataFrame([("e1", "succeeded", 1, "h")], "event_id string, status string, attempt_count int, payload_hash string")
    dry = emit.number_attempts(emit.deliver(p), done)
    assert dry.first().attempt_number == 2 and emit.merge_deliveries(dry, done).first().status == "succeeded"
    real = emit.number_attempts(emit.deliver(p, lambda b: {"status": "failed", "http_tries": 4, "response": "x", "error": "status 500"}), done)
    assert emit.merge_deliveries(real, done).first().status == "failed" and real.first().http_tries == 4


# ---- the whole ----
def test_pipeline_and_rerun(spark, tmp_path):
    f = tmp_path / "contents.jsonl"
    rows = [{"note_id": f"n{k}", "title": f"第{k}号 仓库火灾爆炸 {'甲乙丙丁戊己'[k] * 9}", "liked_count": 10**k, "publish_time": 1704844800 + k} for k in range(6)] + [{"note_id": "n0", "title": "x"}]
    f.write_text("\n".join(json.dumps(r, ensure_ascii=False) for r in rows))
    c = tmp_path / "comments.jsonl"
    c.write_text(json.dumps({"comment_id": "1", "note_id": "n1", "content": "怕"}))
    e = Engine(spark, f"file://{tmp_path}/store")

    def fetcher(url):
        return next(PAGES[k] for k, u in hotsearch.URLS.items() if u == url)

    def steps():
        return {
            "hotsearch": lambda: e.hotsearch(["weibo", "douyin"], "2024-01-10 02:00:00", fetcher, limit=1),
            "crawler": lambda: e.ingest(str(f), jsonl.Context(), comments=str(c)),
            "processing": lambda: e.process("2024-01-11 00:00:00"),
            "analysis": lambda: e.analyse(enrich.stand_in),
            "scoring": e.score,
            "output": lambda: e.output(include_queued=True),
        }

    one = e.run(steps())
    assert one.status == "succeeded", one
    n = one.stats
    assert n["raw_items"] == 9 and n["comments"] == 1 and n["decisions"] == 9 and n["clean_items"] == n["analyses"] == n["assessments"] == n["events"] == 8
    two = e.run(steps())
    assert two.status == "succeeded" and {k: v for k, v in two.stats.items() if k not in ("processing_runs", "attempts")} == {k: v for k, v in n.items() if k not in ("processing_runs", "attempts")}
    assert two.stages[2].details["input_count"] == 0
    assert store.orphans(e.store.read("clean_item_sources"), e.store.read("raw_items"), "raw_item_id", "id").count() == 0
    broken = e.run({"a": lambda: 1 / 0, "b": lambda: ("succeeded", {})}, fail_fast=True)
    assert [s.status for s in broken.stages] == ["failed", "skipped"] and broken.status == "failed"


def test_scheduler():
    c = Config()
    c.collect.keyword_levels, c.collect.accounts = {"level_1": ["a"], "level_2": []}, {"x": "wb"}
    t, state = datetime(2024, 1, 1), {}
    assert [r[0] for r in scheduler.sources(c)][5:] == ["keyword:level_1", "account:x"]

    def collect(key):
        if key == "account:x":
            raise OSError("no")
        return "succeeded"

    cycle = scheduler.run_cycle(c, state, t, collect, lambda: {"status": "succeeded"}, random.Random(1))
    assert cycle.status == "failed" and len(cycle.runs) == 7 == len(state) and all(v > t for v in state.values())
    assert scheduler.run_cycle(c, state, t, collect, lambda: {}).status == "idle"
    c.scheduler.enabled = False
    assert scheduler.run_cycle(c, state, t, collect, lambda: {}).status == "skipped"


def test_stream(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a_contents.jsonl").write_text('{"note_id": "1", "title": "火灾一"}\n{"bad\n')
    e = Engine(spark, f"file://{tmp_path}/store")
    go = lambda: incremental.watch(e, str(land), jsonl.Context(), str(tmp_path / "cp"), "2024-01-02 00:00:00").awaitTermination(120)
    assert go() and e.stats()["decisions"] == 1
    (land / "b_contents.jsonl").write_text('{"note_id": "1", "title": "火灾一"}\n{"note_id": "2", "title": "完全不同的另外一件事情"}\n')
    assert go()
    assert e.stats()["raw_items"] == e.stats()["clean_items"] == 2  # the same line of the same task is the same item


def test_config(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text("store: ${X:-s}\nprocessing: {max_age_hours: 5}\nscoring:\n  thresholds: {red: 80, orange: 60, blue: 30, archive: 0}\n")
    c = config.load(str(p), env={})
    assert (c.store, c.processing.max_age_hours, c.scoring.thresholds["red"]) == ("s", 5, 80)
    for bad in ("store: a\nstore: b\n", "nope: 1\n", "scoring: {weights: {heat: 1}}\n", "store: ${NOPE}\n", "scheduler: {timezone: Mars/X}\n", "scheduler: {hotsearch: {interval_seconds: 5, jitter_min_seconds: 9, jitter_max_seconds: 9}}\n"):
        p.write_text(bad)
        with pytest.raises(config.ConfigError):
            config.load(str(p), env={})
    e = tmp_path / ".env"
    e.write_text("# c\nexport A='x y'\nB=1 # n\n")
    assert config.read_env_file(str(e)) == {"A": "x y", "B": "1"}
    assert config.redacted({"api_key": "k", "api_key_env": "E", "n": [{"password": "p"}]}) == {"api_key": "***", "api_key_env": "E", "n": [{"password": "***"}]}
    assert "WEBHOOK_URL" in config.env_references(Config())


def test_cli(capsys, tmp_path):
    assert cli.main(["validate-config"]) == 0
    assert cli.main(["validate-config", "--strict-env"]) == 2
    (tmp_path / "bad.yaml").write_text("nope: 1")
    assert cli.main(["show-config", "--config", str(tmp_path / "bad.yaml")]) == 2
    assert cli.main(["show-config"]) == 0
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["scoring"]["weights"]["heat"] == 0.15


def test_cli_on_store(spark, capsys, tmp_path):
    pages = tmp_path / "pages"
    pages.mkdir()
    for k in ("weibo", "douyin"):
        (pages / f"{k}.txt").write_text(PAGES[k])
    s = ["--store", f"file://{tmp_path}/s", "--pages", str(pages), "--platform", "weibo", "--platform", "douyin", "--ref-time", "2024-01-01 00:00:00"]
    for verb in ("collect-hotsearch", "process-pending", "run-analysis", "preview-risk", "run-risk", "preview-output", "send-output"):
        assert cli.main([verb, *s, "--include-queued"]) == 0, verb
    assert json.loads(capsys.readouterr().out.splitlines()[-1])["status"] == "succeeded"


def test_queries_match_their_sql(spark):
    """The registered queries against DuckDB on the smallest tables."""
    import duckdb

    from tests.conftest import SF
    from tidemark.plans import queries

    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    plain = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    for name, sql in queries.ORACLE_SQL.items():
        df = queries.QUERIES[name](spark, SF)
        r = con.execute(sql)
        cols = [c[0] for c in r.description]
        assert sorted(cols) == sorted(df.columns), name
        got = sorted(repr(tuple(plain(x[c]) for c in sorted(cols))) for x in df.collect())
        assert got == sorted(repr(tuple(plain(x[cols.index(c)]) for c in sorted(cols))) for x in r.fetchall()), name
    assert set(queries.QUERIES) - set(queries.ORACLE_SQL) == {"dedup_leaders", "dedup_turns", "dedup_documents", "near_dup_edges"}
