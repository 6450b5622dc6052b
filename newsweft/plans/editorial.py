"""Queries over fixed boundary rows: house terms, amounts, model responses.

The inputs are what services return, which no table holds; their SQL is the
rows that must come out, worked out by hand from the rules.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import amounts, responses, terminology, text
from ..operators import joins
from .registry import fixture, literal

_TERMS = [
    (1, "dkba_body", "国軍傘下DKBAと民主カレン仏教徒軍（D.K.B.A.）が", "DVB", "親国軍勢力DKBAとDKBAが"),
    (2, "dkba_title", "DKBA, dkba", "DVB", "親国軍勢力DKBA 親国軍勢力DKBA"),
    (3, "dkba_body", "ERROR: DKBA", "DVB", "ERROR: DKBA"),
    (4, "dkba_body", None, "DVB", None),
    (5, "army", "親軍政権軍と国軍部隊", "DVB", "国軍と国軍"),
    (6, "army", "ミンアウンフラインが率いる軍部隊", "DVB", "国軍"),
    (7, "regime", "軍事政権下の親軍政権当局、軍事政権", "GNLM", "政府の下の政府当局、政府"),
    (8, "regime", "軍事政権と親軍事政権", "DVB", "親軍政権と親親軍政権"),
    (9, "leader_body", "ミン・アウン・フライン上級大将は、Min Aung Hlaing氏は", "  News　 Eleven ", "ミンアウンフライン大統領は、大統領は"),
    (10, "leader_title", "軍事政権トップのミンアウンフライン総司令官、訪中", "Mizzima", "ミンアウンフライン、訪中"),
    (11, "leader_body", "ミンアウンフライン大統領とミンアウンフライン", "Mizzima", "親軍政権トップ・ミンアウンフラインとミンアウンフライン"),
    (12, "all_body", "軍政軍とDKBA、ミンアウンフライン氏率いる部隊", "DVB", "国軍と親国軍勢力DKBA、国軍"),
    (13, "all_title", "国軍総司令官ミンアウンフライン氏、軍事政権を語る", "ＧＮＬＭ", "大統領、政府を語る"),
    (14, "all_body", "ERROR: 軍事政権", "GNLM", "ERROR: 軍事政権"),
    (15, "all_body", "", "DVB", ""),
]


@fixture(literal("id INTEGER, term VARCHAR", [(r[0], r[4]) for r in _TERMS]))
def house_terms(spark, sf_dir):
    rows = spark.createDataFrame([r[:4] for r in _TERMS], "id int, kind string, t string, source string")
    t, s, k = F.col("t"), F.col("source"), F.col("kind")
    out = (F.when(k == "dkba_body", terminology.dkba(t, True)).when(k == "dkba_title", terminology.dkba(t)).when(k == "army", terminology.army(t)).when(k == "regime", terminology.regime(t, s))
           .when(k == "leader_body", terminology.leader(t, s)).when(k == "leader_title", terminology.leader(t, s, True))
           .when(k == "all_body", terminology.house_terms(t, s)).when(k == "all_title", terminology.house_terms(t, s, True)))
    return rows.select("id", out.alias("term"))


_NTH = [(1, "甲と甲と甲", "全称と略称と略称"), (2, "甲", "全称"), (3, "乙", "乙"), (4, "", ""), (5, None, None), (6, "甲甲", "全称略称")]


@fixture(literal("id INTEGER, term VARCHAR", [(r[0], r[2]) for r in _NTH]))
def terminology_nth(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _NTH], "id int, t string").select("id", text.replace_after_first(F.col("t"), "甲", "全称", "略称").alias("term"))


_YEARS = [(1, "2026年05月09日に発表", "5月9日に発表"), (2, "２０２６年5月", "２０２６年5月"), (3, "2026年０５月、2025年5月9日", "5月、2025年5月9日"), (4, "ERROR: 2026年5月", "ERROR: 2026年5月"), (5, None, None), (6, "2026年12月3日と2026年1月", "12月3日と1月")]


@fixture(literal("id INTEGER, summary VARCHAR", [(r[0], r[2]) for r in _YEARS]))
def current_year_dates(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _YEARS], "id int, t string").select("id", terminology.without_current_year(F.col("t"), 2026).alias("summary"))


_GLOSSARY = [("ရန်ကုန်", "Yangon", "ヤンゴン", "ヤンゴン市"), ("", "Bago", "バゴー", ""), ("မန္တလေး", "", "マンダレー", "マンダレー"), ("", "", "x", "y")]
_GLOSSED = [
    (1, "Yangon and Yangons", "in yangon", "body_ja", "ヤンゴン and Yangons"),
    (2, "Yangon", "nothing", "body_ja", "Yangon"),
    (3, "Bago Yangon", "Bago ရန်ကုန်", "title_ja", "Bago ヤンゴン市"),
    (4, "မန္တလေး Bago", "bago မန္တလေး", "body_ja", "マンダレー バゴー"),
    (5, None, "Bago", "body_ja", ""),
]


@fixture(literal("id INTEGER, t VARCHAR", [(r[0], r[4]) for r in _GLOSSED]))
def glossary_output(spark, sf_dir):
    names = ("mm", "en", "body_ja", "title_ja")
    rules = spark.createDataFrame([(i, *g) for i, g in enumerate(_GLOSSARY)], "nth int, " + ", ".join(f"{n} string" for n in names))
    rows = spark.createDataFrame([r[:4] for r in _GLOSSED], "id int, t string, src string, prefer string")
    by = lambda p: joins.with_glossary(rows.filter(F.col("prefer") == p), rules, "t", "src", "nth", p)
    return by("body_ja").unionByName(by("title_ja")).select("id", "t")


_YEN = [
    (1, "計100億チャット（約1円）です", "計100億チャット（約3億7000万円）です"),
    (2, "10億ドル（約390億円）と米ドル 5万（約7億円）", "10億ドルと米ドル 5万"),
    (3, "1.5億チャット（約9円）", "1.5億チャット（約1850万円）"),
    (4, "１２３４万チャット（約x円）", "１２３４万チャット（約45万6580円）"),
    (5, "1万2億チャット（約3円）", "1万2億チャット（約3円）"),
    (6, None, None),
    (7, "1,000チャット（約1円）", "1,000チャット（約37円）"),
]


@fixture(literal("id INTEGER, t VARCHAR", [(r[0], r[2]) for r in _YEN]))
def yen_text_repair(spark, sf_dir):
    """An amount whose units stand in no order is left alone."""
    return spark.createDataFrame([r[:2] for r in _YEN], "id int, t string").select("id", amounts.fix_yen(amounts.drop_foreign_yen(F.col("t"))).alias("t"))


_FACTS = [
    (1, "ကျပ် ၁၂ဒသမ၅ သန်း", [("12.5 သန်း", "1250万チャット（約46万2500円）")]),
    (2, "၂,၂၀၉ ဘီလီယံ ကျော် kyat", [("2,209 ဘီလီယံ ကျော်", "2兆2090億チャット超（約817億3300万円）")]),
    (3, "12 သန်း people", []),
    (4, "ကျပ်သန်းထောင်ချီ", [("သန်းထောင်ချီ", "数十億チャット規模")]),
    (5, "သိန်း ၅၀ ခန့် ကျပ်", [("သိန်း 50 ခန့်", "500万チャット程度（約18万5000円）")]),
    (6, None, []),
]


@fixture(literal("id INTEGER, raw VARCHAR, ja VARCHAR", [(i, *f) for i, _, fs in _FACTS for f in fs]))
def amount_facts(spark, sf_dir):
    rows = spark.createDataFrame([r[:2] for r in _FACTS], "id int, t string")
    return rows.select("id", F.explode(amounts.amount_facts(amounts.normalize_amount_text(F.col("t")))).alias("f")).select("id", "f.raw", "f.ja")


_NUMBERS = [(1, "၂,၂၀၉", 2209.0, "2209", ""), (2, "၁,၀၆၈ဒသမ၆၆ ကျော်", 1068.66, "1068.66", "超"), (3, "none", None, None, ""), (4, "5 လောက်", 5.0, "5", "程度"), (5, "0.5", 0.5, "0.5", "")]


@fixture(literal("id INTEGER, number DOUBLE, label VARCHAR, qualifier VARCHAR", [(r[0], *r[2:]) for r in _NUMBERS]))
def amount_numbers(spark, sf_dir):
    n = spark.createDataFrame([r[:2] for r in _NUMBERS], "id int, t string").withColumn("number", amounts.number_of(F.col("t")))
    return n.select("id", "number", amounts.number_label(F.col("number")).alias("label"), amounts.qualifier(F.col("t")).alias("qualifier"))


_BILLIONS = [
    (1, "支出は50億チャット（約1円）だ", "ကျပ် ဘီလီယံ 50", "支出は500億チャット（約18億5000万円）だ"),
    (2, "50億チャット", "5 ဘီလီယံ ကျပ်, ဘီလီယံ 50 ကျပ်", "50億チャット"),
    (3, "2,209億チャットを超える", "2,209 ဘီလီယံ ကျော် ကျပ်", "2兆2090億チャット（約817億3300万円）を超える"),
    (4, "2209億チャット超", "2,209 ဘီလီယံ ကျော် ကျပ်", "2兆2090億チャット超（約817億3300万円）"),
    (5, "50億チャット", "50 people", "50億チャット"),
    (6, None, "50 ဘီလီယံ ကျပ်", None),
]


@fixture(literal("id INTEGER, t VARCHAR", [(r[0], r[3]) for r in _BILLIONS]))
def billion_repair(spark, sf_dir):
    rows = spark.createDataFrame([r[:3] for r in _BILLIONS], "id int, t string, src string")
    return rows.select("id", amounts.repair_billions(F.col("t"), amounts.normalize_amount_text(F.col("src"))).alias("t"))


_OUTPUTS = [
    (1, "【タイトル】：訳題\n【要約】\n本文一\n\n本文二", "own", False, "", "訳題", "【要約】\n本文一\n本文二"),
    (2, "［超 要 約］短い\n続き\n【タイトル】\n次の行\n本文", "own", False, "短い 続き", "次の行", "【要約】\n本文"),
    (3, "```exit```.", "own", True, None, None, None),
    (4, "【要約】\n古い\nStep 1 考える\n【要約】\n新しい\n→ 手順\n本文を読む\n後", "own", False, "", "own", "【要約】\n新しい"),
    (5, "本文だけ", None, False, "", "（翻訳失敗）", "【要約】\n本文だけ"),
    (6, None, "own", False, "", "own", "【要約】"),
]


@fixture(literal("id INTEGER, skipped BOOLEAN, ultra VARCHAR, title VARCHAR, summary VARCHAR", [(r[0], *r[3:]) for r in _OUTPUTS]))
def summary_blocks(spark, sf_dir):
    rows = spark.createDataFrame([r[:3] for r in _OUTPUTS], "id int, output string, own string")
    return rows.select("id", responses.summary_output("output", "own").alias("o")).select("id", "o.*")


_CHAIN = [(1, "News Eleven", "【タイトル】軍事政権、DKBAと協議\n【要約】\n2026年5月9日、ミンアウンフライン氏は50億チャット（約1円）と10億ドル（約390億円）を約束", "ကျပ် ဘီလီယံ 50",
           "政府、親国軍勢力DKBAと協議", "【要約】\n5月9日、ミンアウンフライン大統領は500億チャット（約18億5000万円）と10億ドルを約束")]


@fixture(literal("id INTEGER, title VARCHAR, summary VARCHAR", [(r[0], r[4], r[5]) for r in _CHAIN]))
def summary_chain(spark, sf_dir):
    """Terms, billions, foreign yen, kyat yen, this year's dates, in that order."""
    rows = spark.createDataFrame([r[:4] for r in _CHAIN], "id int, source string, output string, src string")
    o = rows.withColumn("o", responses.summary_output("output", F.lit("own")))
    s = terminology.house_terms(F.col("o.summary"), F.col("source"))
    s = amounts.repair_billions(s, amounts.normalize_amount_text(F.col("src")))
    s = terminology.without_current_year(amounts.fix_yen(amounts.drop_foreign_yen(s)), 2026)
    return o.select("id", terminology.house_terms(F.col("o.title"), F.col("source"), True).alias("title"), s.alias("summary"))


_JSON = [
    (1, '{"a": 1}', '{"a": 1}'),
    (2, '```json\n[1, 2]\n```', "[1, 2]"),
    (3, 'see [x] then {"k": "}]"} end', '{"k": "}]"}'),
    (4, 'text {"a": [1, 2]} tail', "[1, 2]"),
    (5, "nothing", None),
    (6, None, None),
    (7, r'say {"q": "a \" ] b"} now', r'{"q": "a \" ] b"}'),
]


@fixture(literal("id INTEGER, j VARCHAR", [(r[0], r[2]) for r in _JSON]))
def json_in_prose(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _JSON], "id int, t string").select("id", responses.extract_json("t").alias("j"))


_ERRORS = [(1, '{"error": {"code": 429, "x": 1}}', 429, True), (2, "HTTP 503 Service", 503, True), (3, "status_code: 404", 404, False), (4, "Model is Currently experiencing HIGH demand", None, True), (5, "bad key", None, False), (6, None, None, False), (7, "RESOURCE_EXHAUSTED", None, True)]


@fixture(literal("id INTEGER, code INTEGER, second BOOLEAN", [(r[0], *r[2:]) for r in _ERRORS]))
def error_kinds(spark, sf_dir):
    e = F.col("message")
    return spark.createDataFrame([r[:2] for r in _ERRORS], "id int, message string").select("id", responses.error_code(e).alias("code"), responses.second_model(e).alias("second"))


_USAGE = [
    (1, '{"prompt_token_count": 10, "candidates_token_count": 5, "total_token_count": 15}', 10, 5, 15),
    (2, '{"promptTokenCount": 7, "totalTokenCount": "9"}', 7, None, 9),
    (3, "{}", None, None, None),
    (4, None, None, None, None),
    (5, '{"prompt_token_count": 3, "promptTokenCount": 4}', 3, None, None),
]


@fixture(literal("id INTEGER, prompt BIGINT, candidates BIGINT, total BIGINT", [(r[0], *r[2:]) for r in _USAGE]))
def usage_extract(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _USAGE], "id int, u string").select("id", responses.token_usage(F.col("u")).alias("u")).select("id", "u.*")


_MAIL = [(1, '{"error": {"errors": [{"reason": "invalidArgument"}], "status": "X"}}', "invalidArgument"), (2, '{"error": {"status": "UNAUTHENTICATED", "message": "m"}}', "UNAUTHENTICATED"), (3, '{"error": {"message": "m"}}', "m"), (4, "no json", None), (5, None, None)]


@fixture(literal("id INTEGER, reason VARCHAR", [(r[0], r[2]) for r in _MAIL]))
def mail_errors(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _MAIL], "id int, body string").select("id", responses.mail_error(F.col("body")).alias("reason"))


_UNTRANSLATED = [(1, "English only", True), (2, "ကျပ်", True), (3, "English と日本", False), (4, "  ", False), (5, None, False), (6, "カナ", False)]


@fixture(literal("id INTEGER, again BOOLEAN", [(r[0], r[2]) for r in _UNTRANSLATED]))
def untranslated(spark, sf_dir):
    return spark.createDataFrame([r[:2] for r in _UNTRANSLATED], "id int, t string").select("id", responses.untranslated(F.col("t")).alias("again"))
