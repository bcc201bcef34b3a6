"""Configuration: a validated tree of plain dataclasses, read from YAML with environment references."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, fields, is_dataclass
from pathlib import Path
from typing import Any
from zoneinfo import ZoneInfo

import yaml

from .schema import CATEGORIES, CRAWL_PLATFORMS, HOT_PLATFORMS, LEVELS

# ---- fixed values: the default rules, weights and thresholds ----
DEFAULT_RULES = {
    "sudden_event": (
        100,
        [
            "爆炸", "爆燃", "起火", "火灾", "坍塌", "塌方", "垮塌", "交通事故", "车祸", "追尾", "矿难", "瓦斯",
            "透水", "泄漏", "毒气", "化学品泄漏", "坠机", "坠毁", "沉船", "翻船", "踩踏", "施工事故", "高处坠落", "触电",
            "机械伤害", "溺水", "地震", "余震", "震感", "洪水", "汛情", "决堤", "内涝", "台风", "山体滑坡", "泥石流",
            "暴雪", "冰雹", "龙卷风", "地陷", "地面塌陷", "森林火灾", "食物中毒", "集体腹泻", "集体呕吐", "疑似食物中毒", "疫情", "聚集性疫情",
            "传染病", "职业中毒", "饮用水污染", "水质异常", "疫苗异常", "持刀伤人", "砍伤", "刺伤", "无差别伤人", "报复社会", "劫持", "人质",
            "纵火", "投毒", "爆炸物", "可疑包裹", "持刀", "行凶",
        ],
    ),
    "mass_event": (
        95,
        [
            "聚集", "聚集上访", "群体聚集", "围堵", "堵门", "堵路", "堵桥", "罢工", "罢运", "罢市", "停工", "讨薪",
            "讨要工资", "静坐", "拉横幅", "举牌子", "集体维权", "聚集维权", "医闹", "校闹", "聚集讨说法",
        ],
    ),
    "police_stability": (
        92,
        [
            "警察打人", "暴力执法", "执法冲突", "涉案警察", "辅警打人", "协警", "警车事故", "派出所", "警民冲突", "袭警", "辱警", "阻碍执法",
            "假警察", "冒充警察", "警察涉案", "看守所", "在押人员",
        ],
    ),
    "livelihood_sensitive": (
        75,
        [
            "拆迁", "征地", "强制拆除", "补偿款", "欠薪", "拖欠工资", "农民工讨薪", "物业纠纷", "停水", "停电", "停气", "供暖",
            "房价", "烂尾楼", "延期交房", "校园安全", "校园霸凌", "欺凌", "体罚", "食堂卫生", "医疗纠纷", "医患冲突", "环境污染", "偷排",
            "异味", "排放超标", "食品安全", "过期食品", "黑作坊", "养老", "养老院", "疫苗", "学区", "入学难", "强制消费",
        ],
    ),
    "cyber_fraud": (
        85,
        [
            "数据泄露", "信息泄露", "个人信息泄露", "黑客攻击", "网站被黑", "勒索病毒", "系统瘫痪", "宕机", "网络攻击", "钓鱼网站", "撞库", "电信诈骗",
            "刷单返利", "杀猪盘", "冒充公检法", "虚假投资", "虚假理财", "集资诈骗", "养老诈骗", "冒充客服", "机票退改签诈骗",
        ],
    ),
    "other": (30, []),
}
COMPONENT_WEIGHTS = {"keyword_category": 0.25, "source": 0.10, "heat": 0.15, "llm_category": 0.15, "sentiment": 0.15, "llm_risk": 0.20}
THRESHOLDS = {"red": 85.0, "orange": 70.0, "blue": 40.0, "archive": 0.0}
TOP_RANK_WEIGHTS = {"weibo": 95.0, "douyin": 90.0, "baidu": 85.0, "zhihu": 80.0, "bilibili": 75.0}
LEVEL_FLAGS = {"red": (True, True), "orange": (True, True), "blue": (True, False), "archive": (False, False)}
SENTIMENT_WEIGHTS = {"strong_negative": 100, "negative": 75, "angry": 95, "anxious": 80, "distrustful": 75, "questioning": 50, "neutral": 40, "positive": 10, "supportive": 5, "mixed": 50, "invalid": 0}
# ---- end of fixed values ----


class ConfigError(ValueError):
    pass


def _need(ok: bool, what: str) -> None:
    if not ok:
        raise ConfigError(what)


@dataclass
class Category:
    weight: float = 30.0
    keywords: list[str] = field(default_factory=list)

    def __post_init__(self):
        _need(len(set(self.keywords)) == len(self.keywords) and all(k.strip() for k in self.keywords), "keywords must not repeat or be blank")


@dataclass
class Processing:
    max_age_hours: int = 72
    missing_published_at: str = "keep"  # or drop
    title_similarity: float = 0.90
    content_similarity: float = 0.88
    content_dedup: bool = True
    url_dedup: bool = True
    cross_platform_merge: bool = True
    hotsearch_id_dedup: bool = True
    link_anchor_duplicates: bool = True
    tracking_params: list[str] = field(default_factory=list)

    def __post_init__(self):
        _need(self.missing_published_at in ("keep", "drop"), "missing_published_at must be keep or drop")
        _need(0 < self.title_similarity <= 1 and 0 < self.content_similarity <= 1, "similarities must be in (0, 1]")


@dataclass
class Scoring:
    weights: dict[str, float] = field(default_factory=lambda: dict(COMPONENT_WEIGHTS))
    thresholds: dict[str, float] = field(default_factory=lambda: dict(THRESHOLDS))
    source_default: float = 50.0
    source_ordinary: float = 60.0
    top_rank_weights: dict[str, float] = field(default_factory=lambda: dict(TOP_RANK_WEIGHTS))
    manual_review_confidence: float = 0.6
    review_when_no_comments: bool = False
    account_weights: dict[str, float] = field(default_factory=dict)

    def __post_init__(self):
        _need(set(self.weights) == set(COMPONENT_WEIGHTS), "weights must name the six components")
        _need(abs(sum(self.weights.values()) - 1) <= 1e-9, "weights must sum to one")
        _need(set(self.thresholds) == set(LEVELS), "thresholds must name the four levels")
        t = [self.thresholds[x] for x in LEVELS]
        _need(all(a > b for a, b in zip(t, t[1:])), "thresholds must fall from red to archive")


@dataclass
class Interval:
    interval_seconds: int = 300
    jitter_min_seconds: int = 0
    jitter_max_seconds: int = 30

    def __post_init__(self):
        _need(0 <= self.jitter_min_seconds <= self.jitter_max_seconds, "jitter_max must be at least jitter_min")
        _need(self.jitter_min_seconds < self.interval_seconds, "jitter_min must be below the interval")


@dataclass
class Scheduler:
    enabled: bool = True
    timezone: str = "UTC"
    max_concurrent_tasks: int = 3
    task_timeout_seconds: int = 1800
    hotsearch: Interval = field(default_factory=Interval)
    keyword: Interval = field(default_factory=lambda: Interval(1800))
    account: Interval = field(default_factory=lambda: Interval(3600))

    def __post_init__(self):
        try:
            ZoneInfo(self.timezone)
        except (KeyError, ValueError, OSError) as e:
            raise ConfigError(f"unknown time zone {self.timezone}") from e


@dataclass
class Output:
    webhook_url_env: str = "WEBHOOK_URL"
    trigger: str = "舆情预警"
    max_retries: int = 3
    backoff_seconds: float = 5.0
    timeout_seconds: float = 15.0
    dry_run: bool = True
    levels: dict[str, list[bool]] = field(default_factory=lambda: {k: list(v) for k, v in LEVEL_FLAGS.items()})

    def __post_init__(self):
        _need(set(self.levels) == set(LEVELS), "output levels must name the four levels")


@dataclass
class Analysis:
    base_url_env: str = "LLM_BASE_URL"
    api_key_env: str = "LLM_API_KEY"
    model_env: str = "LLM_MODEL"
    temperature: float = 0.1
    max_output_tokens: int = 2000
    max_retries: int = 2
    timeout_seconds: float = 60.0
    structured_output: bool = True
    max_input_comments: int = 100
    prompt_dir: str = ""
    sentiment_weights: dict[str, float] = field(default_factory=lambda: dict(SENTIMENT_WEIGHTS))


@dataclass
class Collect:
    hot_platforms: list[str] = field(default_factory=lambda: list(HOT_PLATFORMS))
    crawl_platforms: list[str] = field(default_factory=lambda: list(CRAWL_PLATFORMS[:4]))
    keyword_levels: dict[str, list[str]] = field(default_factory=dict)
    accounts: dict[str, str] = field(default_factory=dict)
    max_items: int = 50
    max_retries: int = 2
    backoff_seconds: float = 0.5
    timeout_seconds: float = 15.0

    def __post_init__(self):
        _need(set(self.hot_platforms) <= set(HOT_PLATFORMS), "unknown hot-search platform")
        _need(set(self.crawl_platforms) <= set(CRAWL_PLATFORMS), "unknown crawler platform")
        for words in self.keyword_levels.values():
            _need(len(set(words)) == len(words) and all(w.strip() for w in words), "keywords must not repeat or be blank")


@dataclass
class Config:
    store: str = ""
    raw_retention_days: int = 30
    processed_retention_days: int = 180
    rules: dict[str, Category] = field(default_factory=lambda: {k: Category(float(w), list(kws)) for k, (w, kws) in DEFAULT_RULES.items()})
    processing: Processing = field(default_factory=Processing)
    scoring: Scoring = field(default_factory=Scoring)
    scheduler: Scheduler = field(default_factory=Scheduler)
    output: Output = field(default_factory=Output)
    analysis: Analysis = field(default_factory=Analysis)
    collect: Collect = field(default_factory=Collect)

    def __post_init__(self):
        _need(set(self.rules) == set(CATEGORIES), "rules must name the six categories")
        _need(self.processed_retention_days >= self.raw_retention_days, "processed retention must be at least raw retention")


class _Unique(yaml.SafeLoader):
    """Rejects a key that stands twice in a mapping."""

    def construct_mapping(self, node, deep=False):
        seen = set()
        for k, _ in node.value:
            key = self.construct_object(k, deep=True)
            if key in seen:
                raise ConfigError(f"key {key!r} stands twice, line {k.start_mark.line + 1}")
            seen.add(key)
        return super().construct_mapping(node, deep)


_REF = re.compile(r"\$\{([A-Za-z_][A-Za-z0-9_]*)(?::-([^}]*))?\}")
_SENSITIVE = re.compile(r"password|secret|token|api_?key|cookie|authorization|webhook_url$", re.I)


def expand(value: Any, env: dict[str, str]) -> Any:
    """`${NAME}` and `${NAME:-default}` at any depth."""
    if isinstance(value, dict):
        return {k: expand(v, env) for k, v in value.items()}
    if isinstance(value, list):
        return [expand(v, env) for v in value]
    if not isinstance(value, str):
        return value

    def one(m: re.Match) -> str:
        if m[1] in env:
            return env[m[1]]
        _need(m[2] is not None, f"environment variable {m[1]} isn't set")
        return m[2]

    return _REF.sub(one, value)


def env_references(value: Any, key: str = "") -> list[str]:
    """Names that keys ending in `_env` refer to, sorted."""
    if is_dataclass(value):
        value = {f.name: getattr(value, f.name) for f in fields(value)}
    if isinstance(value, dict):
        return sorted({n for k, v in value.items() for n in env_references(v, str(k))})
    if isinstance(value, list):
        return sorted({n for v in value for n in env_references(v, key)})
    return [value] if key.endswith("_env") and isinstance(value, str) and value else []


def redacted(value: Any, key: str = "") -> Any:
    if is_dataclass(value):
        value = {f.name: getattr(value, f.name) for f in fields(value)}
    if isinstance(value, dict):
        return {k: redacted(v, str(k)) for k, v in value.items()}
    if isinstance(value, list):
        return [redacted(v, key) for v in value]
    return "***" if isinstance(value, str) and value and _SENSITIVE.search(key) and not key.endswith("_env") else value


def read_env_file(path: str) -> dict[str, str]:
    out = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        line = line.strip().removeprefix("export ").strip()
        if line and not line.startswith("#") and "=" in line:
            k, v = line.split("=", 1)
            v = v.strip()
            quoted = len(v) > 1 and v[0] == v[-1] and v[0] in "'\""
            out[k.strip()] = v[1:-1] if quoted else re.split(r"\s+#", v)[0]
    return out


def _build(kind: type, data: Any, path: str = "config"):
    _need(isinstance(data, dict), f"{path} must be a mapping")
    known = {f.name: f for f in fields(kind)}
    _need(set(data) <= set(known), f"{path} has unknown keys: {sorted(set(data) - set(known))}")
    out = {}
    for k, v in data.items():
        f = known[k]
        default = f.default_factory() if callable(f.default_factory) else f.default
        if k == "rules":
            out[k] = {c: _build(Category, x, f"{path}.rules.{c}") for c, x in v.items()}
        elif is_dataclass(default):
            out[k] = _build(type(default), v, f"{path}.{k}")
        else:
            out[k] = v
    return kind(**out)


def load(path: str | None = None, env_file: str | None = None, env: dict[str, str] | None = None) -> Config:
    """Reads a file (none: the defaults); the process's environment wins over the env file."""
    if path is None:
        return Config()
    env = {**(read_env_file(env_file) if env_file else {}), **(os.environ if env is None else env)}
    try:
        data = yaml.load(Path(path).read_text(encoding="utf-8"), _Unique)
    except yaml.YAMLError as e:
        raise ConfigError(str(e)) from e
    return _build(Config, expand(data or {}, env))
