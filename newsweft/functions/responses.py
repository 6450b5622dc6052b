"""Model responses as columns: JSON inside prose, summary blocks, error kinds, scores and reasons."""

from __future__ import annotations

import json
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .numbers import clamp_score, safe_int
from .text import normalize_key, strip, text, truncate

# --- JSON inside prose ---


def _balanced(s: str, opener: str, closer: str) -> list[str]:
    """Top-level bracketed parts; brackets in JSON strings don't count."""
    out, depth, start, quoted, escaped = [], 0, 0, False, False
    for i, ch in enumerate(s):
        if quoted:
            quoted = escaped or ch != '"'
            escaped = not escaped and ch == "\\"
        elif ch == '"':
            quoted = True
        elif ch == opener:
            start = start if depth else i
            depth += 1
        elif ch == closer and depth:
            depth -= 1
            if not depth:
                out.append(s[start : i + 1])
    return out


def json_in(s: str | None) -> str | None:
    """The JSON of a response: the whole, without its fences, the first array or object that parses, or what stands between the outermost brackets."""
    s = (s or "").strip()
    bare = re.sub(r"^\s*```(?:json)?\s*|\s*```\s*$", "", s, flags=re.I | re.M).strip()
    outer = re.search(r"(\[.*\]|\{.*\})", bare, re.S)
    for part in [s, bare, *_balanced(bare, "[", "]"), *_balanced(bare, "{", "}"), *([outer[1]] if outer else [])]:
        try:
            json.loads(part)
        except ValueError:
            continue
        return part
    return None


@F.pandas_udf(T.StringType())
def extract_json(s: pd.Series) -> pd.Series:
    return s.map(json_in)


# --- summaries ---

#: Headings of a summary output, where a summary ends, and lines of a working-out.
SUMMARY = re.compile(r"^【\s*要約\s*】\s*$")
TITLE = re.compile(r"^【\s*タイトル\s*】\s*(.*)$")
ULTRA = re.compile(r"^【\s*超\s*要\s*約\s*】")
HEADING = re.compile(r"^【.*?】")
ENDS = re.compile(r"^本文を読む|^【\s*タイトル\s*】")
WORKING = re.compile(r"^(Step\s*\d+|Q\d+\.|→)")
EXIT = re.compile(r"^\s*(?:`{0,3})?\s*exit\s*(?:`{0,3})?\.?\s*$", re.I)
SUMMARY_HEADING, NO_TITLE = "【要約】", "（翻訳失敗）"
_BRACKETS = str.maketrans("［〔〖］〕〗", "【【【】】】")


def heading_form(line: str) -> str:
    """A line for telling headings: one kind of bracket, no invisible characters."""
    line = line.translate(_BRACKETS).replace("　", " ").replace("\xa0", " ")
    line = re.sub(r"(要)\s+(約)", r"\1\2", re.sub("[​‌‍﻿]", "", line))
    return unicodedata.normalize("NFC", line)


def cut_ultra(lines: list[str]) -> tuple[str, list[str]]:
    """The short summary up to the next heading, and the lines without it."""
    norm = [heading_form(x) for x in lines]
    at = next((i for i, x in enumerate(norm) if ULTRA.match(x)), None)
    if at is None:
        return "", lines
    end = next((i for i in range(at + 1, len(norm)) if HEADING.match(norm[i])), len(norm))
    inline = ULTRA.sub("", norm[at]).strip()
    return " ".join([*([inline] if inline else []), *lines[at + 1 : end]]).strip(), lines[:at] + lines[end:]


def last_summary(output: str) -> list[str]:
    """Lines behind the last summary heading, without the working-out."""
    lines = [x.strip() for x in output.splitlines() if x.strip()]
    heads = [i for i, x in enumerate(lines) if SUMMARY.match(x)]
    lines = lines[heads[-1] + 1 if heads else 0 :]
    end = next((i for i, x in enumerate(lines) if ENDS.match(x)), len(lines))
    return [x for x in lines[:end] if not WORKING.match(x)]


def read_output(output: str | None, title: str | None) -> dict:
    """``skipped, ultra, title, summary`` of one summary output; ``title`` is the article's own, for want of another."""
    output = (output or "").strip()
    if EXIT.match(output):
        return {"skipped": True, "ultra": None, "title": None, "summary": None}
    ultra, lines = cut_ultra([unicodedata.normalize("NFC", x).strip() for x in output.splitlines() if x.strip()])
    at = next((i for i, x in enumerate(lines) if TITLE.match(x)), None)
    found = ""
    if at is not None:
        inline = TITLE.match(lines.pop(at))[1].strip()
        found = inline.lstrip(":：").strip() if inline else lines.pop(at).strip() if at < len(lines) else ""
    if sum(bool(SUMMARY.match(x)) for x in output.split("\n")) >= 2 or any(WORKING.match(x.strip()) for x in output.splitlines()):
        lines = last_summary(output)
    if not lines or not SUMMARY.match(lines[0]):
        lines = [SUMMARY_HEADING, *lines]
    return {"skipped": False, "ultra": ultra, "title": (found or title or NO_TITLE).strip(), "summary": "\n".join(lines).strip()}


OUTPUT = T.StructType([T.StructField("skipped", T.BooleanType()), *(T.StructField(n, T.StringType()) for n in ("ultra", "title", "summary"))])


@F.pandas_udf(OUTPUT)
def summary_output(output: pd.Series, title: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([read_output(o, t) for o, t in zip(output, title)], columns=OUTPUT.names)


def untranslated(c: Column) -> Column:
    """Not blank, and without any kana or Chinese character."""
    return (strip(F.coalesce(c, F.lit(""))) != "") & ~c.rlike(r"[\x{3040}-\x{30FF}\x{4E00}-\x{9FFF}\x{3400}-\x{4DBF}]")


# --- errors ---

#: Patterns of a status code in an error text; what calls for the second model.
CODE_PATTERNS = [r'"code"\s*:\s*(\d{3})', r"\bHTTP\s+(\d{3})\b", r"\bstatus_code\s*[=:]\s*(\d{3})\b"]
FALLBACK_CODES = [429, 503]
FALLBACK_SIGNALS = ['"code": 429', '"code": 503', "high demand", "currently experiencing high demand", "rate limit", "resource_exhausted", "unavailable"]


def error_code(message: Column) -> Column:
    return F.coalesce(*[F.regexp_extract(message, f"(?i){p}", 1).try_cast("int") for p in CODE_PATTERNS])


def second_model(message: Column) -> Column:
    """Whether an error calls for the second model: overload and quota, nothing else."""
    hit = F.coalesce(error_code(message).isin(*FALLBACK_CODES), F.lit(False))
    for s in FALLBACK_SIGNALS:
        hit = hit | F.contains(F.lower(message), F.lit(s))
    return F.coalesce(hit, F.lit(False))


def mail_error(body: Column) -> Column:
    """Reason of a mail API's error: of its first error, else its status, else its message."""
    path = lambda p: F.get_json_object(body, p)
    return F.coalesce(path("$.error.errors[0].reason"), path("$.error.status"), path("$.error.message"))


def token_usage(c: Column) -> Column:
    """``struct<prompt, candidates, total>`` of a usage object in either spelling."""
    pick = lambda snake, camel: F.coalesce(F.get_json_object(c, f"$.{snake}"), F.get_json_object(c, f"$.{camel}")).try_cast("long")
    return F.struct(pick("prompt_token_count", "promptTokenCount").alias("prompt"), pick("candidates_token_count", "candidatesTokenCount").alias("candidates"), pick("total_token_count", "totalTokenCount").alias("total"))


# --- second scores ---

#: Texts of a second score's result and the characters kept of each; lists, the items kept and characters of each.
RESULT_TEXTS = {
    "decision": 40, "rank_group": 10, "direct_myanmar_relevance": 20, "country_weight_tier": 40, "domestic_region_tier": 40,
    "conflict_damage_target": 40, "event_when": 80, "event_who": 120, "event_where": 120, "event_what": 160,
    "same_day_event_relation": 40, "same_day_event_key": 180, "same_day_diff_ja": 220, "same_day_score_adjustment_ja": 220,
    "adopted_archive_relation": 40, "adopted_archive_diff_ja": 220, "novelty_vs_archive_or_same_topic": 40, "topic_key": 120,
}
RESULT_LISTS = {"priority_topic_tags": (8, 80), "editorial_axes": (6, 80), "reasons": (4, 90), "risk_flags": (4, 90)}
SOURCE_ROWS = 12
DUPLICATE = "same_event_duplicate"
#: Labels of the parts of a reason, and characters kept of all.
REASON_LISTS = [("理由", "reasons"), ("注意", "risk_flags"), ("軸", "editorial_axes"), ("JS優先トピック", "priority_topic_tags")]
REASON_BEFORE_4W = [("直接関連", "direct_myanmar_relevance"), ("国名階層", "country_weight_tier"), ("紛争被害対象", "conflict_damage_target")]
REASON_AFTER_4W = [("同日内判定", "same_day_event_relation"), ("同日差分", "same_day_diff_ja"), ("同日スコア調整", "same_day_score_adjustment_ja"), ("過去採用との差分判定", "adopted_archive_relation"),
                   ("差分", "adopted_archive_diff_ja"), ("新規性", "novelty_vs_archive_or_same_topic"), ("トピックキー", "topic_key")]
REASON_LIMIT = 3000
#: Which score was taken.
SOURCE_NONE, SOURCE_LLM, SOURCE_ML, SOURCE_TIE = "ML採用（Geminiスコアなし）", "Gemini採用", "ML採用", "同点（ML/Gemini）"


def second_score(item: Column) -> Column:
    """A result object in JSON as a struct: texts cut, a single text where a list is due taken as a list, lists without blanks and cut."""
    get = lambda name: F.get_json_object(item, f"$.{name}")
    empty = F.array().cast("array<string>")

    def items(name: str) -> Column:
        raw = get(name)
        return F.coalesce(F.when(F.startswith(F.trim(raw), F.lit("[")), F.from_json(raw, "array<string>")), F.when(text(raw) != "", F.array(raw)), empty)

    lists = {n: F.slice(F.transform(F.filter(items(n), lambda x: text(x) != ""), lambda x: truncate(x, size)), 1, k) for n, (k, size) in RESULT_LISTS.items()}  # noqa: B023
    rows = F.filter(F.transform(F.coalesce(F.when(F.startswith(F.trim(get("same_day_score_source_rows")), F.lit("[")), F.from_json(get("same_day_score_source_rows"), "array<string>")), empty),
                                lambda x: safe_int(x, -1)), lambda x: x > 0)
    return F.struct(clamp_score(get("gemini_score")).alias("score"), *[truncate(text(get(n)), size).alias(n) for n, size in RESULT_TEXTS.items()],
                    *[c.alias(n) for n, c in lists.items()], F.slice(rows, 1, SOURCE_ROWS).alias("same_day_score_source_rows"))


def event_key(result: Column, date_key: Column) -> Column:
    """What ties articles that a model calls duplicates of one event: its key, or when, who, where and what; blank if it is too short."""
    parts = F.array_join(F.array(*[result[n] for n in ("event_when", "event_who", "event_where", "event_what")]), "|")
    key = normalize_key(F.when(result["same_day_event_key"] != "", result["same_day_event_key"]).otherwise(parts))
    use = (result["same_day_event_relation"] == DUPLICATE) & (F.length(key) >= 8)
    return F.when(use, F.concat(F.when(date_key != "", date_key).otherwise("current"), F.lit(":"), key)).otherwise("")


def reason_text(result: Column) -> Column:
    """The parts of a result that are there, labelled and joined."""
    label = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    joined = lambda n: F.array_join(result[n], " / ")
    parts = [F.when(F.size(result[n]) > 0, label(name, joined(n))) for name, n in REASON_LISTS]
    texts = lambda pairs: [F.when(result[n] != "", label(name, result[n])) for name, n in pairs]
    four = [result[n] for n in ("event_when", "event_who", "event_where", "event_what")]
    event = F.when(F.concat(*four) != "", label("4W", F.concat_ws(" / ", *[F.when(x != "", x).otherwise("-") for x in four])))
    return F.coalesce(F.substring(F.concat_ws(" / ", *parts, *texts(REASON_BEFORE_4W), event, *texts(REASON_AFTER_4W)), 1, REASON_LIMIT), F.lit(""))


def score_label(ml: Column, llm: Column) -> Column:
    a, b = clamp_score(ml), clamp_score(llm)
    return F.when(llm.isNull(), SOURCE_NONE).when(b > a, SOURCE_LLM).when(a > b, SOURCE_ML).otherwise(SOURCE_TIE)
