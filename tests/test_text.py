"""Text, date, HTML and address rules on worked examples."""

import datetime

import pytest
from pyspark.sql import functions as F

from seatflow.functions import dates as D
from seatflow.functions import html as H
from seatflow.functions import text as T
from seatflow.functions import urls as U
from seatflow.functions.names import senior_pastor_of


def each(spark, pairs, expression, kind="string"):
    """The expression of column v over the inputs, in order."""
    rows = spark.createDataFrame([(i, v) for i, (v, *_) in enumerate(pairs)], f"i int, v {kind}")
    return [r["x"] for r in rows.select("i", expression.alias("x")).orderBy("i").collect()]


def check(spark, pairs, expression, kind="string"):
    assert each(spark, pairs, expression, kind) == [w for _, w in pairs]


def test_pay(spark):
    pairs = [
        ("월 250만원", (250, None)), ("90~120만원", (90, 120)), ("월 95-100만원", (95, 100)), ("연봉 3,600만원", (3600, None)), ("월 300만원 (연봉 3,600만원)", (300, None)),
        ("전도사 월 160, 강도사 월 170", (None, None)), ("사택 전세 5천만원", (None, None)), ("아파트(24평)", (None, None)), ("국민연금 50% 지원", (None, None)), ("2500000", (250, None)),
        ("700만원", (None, None)), ("(1) 내규", (None, None)), ("건축헌금 1억", (None, None)), ("", (None, None)), (None, (None, None)), ("3천만원", (3000, None)), ("99999999999999999999만원", (None, None)), ("90만원 ~ 120만원", (90, 120)), ("월 90만–120만", (90, 120)), ("90만원부터 120만원", (None, None)),
    ]
    assert [(x["low"], x["high"]) for x in each(spark, pairs, T.pay_of(F.col("v")))] == [w for _, w in pairs]
    check(spark, [("월 250만원", "MONTH"), ("연 250만원", "YEAR"), ("110", "MONTH"), ("3,500", "YEAR"), ("700", None), (None, None)], T.period_of(F.col("v")))
    note = T.pay_note_of(F.col("v"), F.lit("교회 내규"))
    check(spark, [("월 250만원", "교회 내규"), ("월 160, 월 170", "교회 내규 · 월 160, 월 170"), ("교회 내규 (월 160, 월 170)", "교회 내규 (월 160, 월 170)"), (None, "교회 내규")], note)


def test_titles_and_names(spark):
    check(spark, [
        ("(끌어올림) 부목사 청빙", "부목사 청빙"), ("[수정, 끌어올림] 청빙(끌어올림)", "청빙"), ("끌올- 교육목사", "교육목사"), ("★끌올★ 청빙", "청빙"), ("청빙 끌어올림", "청빙"), ("청빙끌어올림", "청빙끌어올림"),
        ("(대전) 청빙", "(대전) 청빙"), ("[재공고] 청빙...", "[재공고] 청빙..."), ("(끌어올림)", "(끌어올림)"), ("대구성북교회- 부목사", "대구성북교회- 부목사"), (None, None),
    ], T.clean_title(F.col("v")))
    check(spark, [("[군산] 개복교회(전북 군산)", "개복교회"), ("세상의 빛 이레교회", "세상의빛이레교회"), ("(x)", None), (None, None)], T.normalized_church(F.col("v")))
    check(spark, [("ＡＢ 교회", "ab교회"), ("가·나(창원)", "가나")], T.name_key(F.col("v")))
    check(spark, [("a b c　d\n", "abcd")], T.squeeze(F.col("v")))
    check(spark, [("구인 완료", True), ("진행", False), (None, False)], T.closed_by_board(F.lit("조기 마감 될 수 있습니다"), F.col("v")))
    check(spark, [("[마감] 청빙", True), ("청빙 완료", True), ("6/19 마감", False)], T.closed_by_board(F.col("v"), F.lit(None).cast("string")))
    check(spark, [("메일: a.b@c.org (이름), 가나@d.kr / a.b@c.org", "a.b@c.org, 가나@d.kr"), ("x@y,net", "x@y,net"), (None, None)], T.emails_only(F.col("v")))


def test_places(spark):
    check(spark, [("서울시 송파구", "송파구"), ("서울특별시", None), ("서울 중구", "중구"), ("서울숲", "서울숲"), (None, None)], T.city_without_region(F.col("v"), F.lit("SEOUL")))
    check(spark, [("부산진구", "부산진구"), ("부산 진구", "진구")], T.city_without_region(F.col("v"), F.lit("BUSAN")))
    check(spark, [("인평1길 북삼교회", None), (" 대청로 8 교회 ", "대청로 8 교회"), ("안중읍 837-13", "안중읍 837-13"), ("휴가 10일", None), ("중앙 로 8", "중앙 로 8"), ("역삼동12", "역삼동12"), ("로 8", None), ("Teheran로12", "Teheran로12"), (None, None)], T.address_or_none(F.col("v")))
    check(spark, [("길41", True), ("길412", False), ("봉천길4", False), ("x길41호", True), ("", True)], T.fits(F.col("v"), F.lit("길41")))


def test_dates(spark):
    on = F.to_date(F.lit("2026-08-10"))
    d = datetime.date
    check(spark, [
        ("2026. 8. 31. 까지", d(2026, 8, 31)), ("2026-08-01 ~ 9.15", d(2026, 9, 15)), ("20260831", d(2026, 8, 31)), ("2026년 2월 31일", None), ("9월 3일", d(2026, 9, 3)), ("3월 3일", None),
        ("1차 2026.8.1, 2차 2026.8.20", d(2026, 8, 20)), ("채용시까지", None), ("1999.1.1", None), (None, None), ("9월3일 또는 10 월 4 일", d(2026, 10, 4)), ("9월 중", None), ("9월 3일 10월 2", d(2026, 9, 3)), ("129월 3일", None),
    ], D.deadline_in(F.col("v"), on))
    today = F.to_date(F.lit("2026-01-05"))
    check(spark, [("12:30", d(2026, 1, 5)), ("01-05", d(2026, 1, 5)), ("12-31", d(2025, 12, 31)), ("2025.12.01", d(2025, 12, 1)), ("08.27", d(2025, 8, 27)), ("1-5", d(2026, 1, 5)), ("02-29", None), ("13-01", None), ("??", None)], D.short_date(F.col("v"), today))
    check(spark, [("2026-08-31", d(2026, 5, 31)), ("2026-05-31", d(2026, 2, 28))], D.months_before(F.col("v").cast("date"), 3))
    check(spark, [("2026-01-05", False), ("2026-01-04", True), (None, False)], D.deadline_passed(F.col("v").cast("date"), today))


def test_pastor(spark):
    none = F.lit(None).cast("string")
    check(spark, [
        ("담임목사 : 홍길동", "홍길동"), ("담임목사: 위임목사 홍길동 목사", "홍길동"), ("(담임목사 홍길동)", "홍길동"), ("#담임목사 소개", None), ("2. 담임목사 처우", None), ("담임목사님과 함께", None),
        ("담임목사 : 없음", None), ("담임목사 :\n김녕교회", None), ("담임목사 홍 길 동", "홍길동"), (None, None), ("담임목사: 홍길동목사", "홍길동"), ("담임목회자 : 홍길동위임목사", "홍길동"), ("3. 담임 목회자명 – 홍길동", "홍길동"),
        ("담임목사: 홍길동(위임)", "홍길동"), ("서울연회 어느교회 (담임목사: 홍길동)에서", "홍길동"), ("담임목회자: 담임목사 홍길동 / 원로목사 김철수", "홍길동"), ("후임담임목사님을 재 청빙합니다.", None), ("담임목사 청빙위원회", None),
        ("담임목사 청빙 공고", None), ("샘물교회 담임목사 청빙공고", None), ("(담임목사님 이메일)", None), ("담임목사\n\n모집인원\n1명", None), ("홍길동 담임목사\n\n기타", None), ("담임목사 : 공석(안계심)", None), ("담임목사 : 홍길", "홍길"), ("담임목사 홍길", None),
        ("담임목사 추천서 1부\n\n담임목사 : 홍길동", "홍길동"), ("담임목사님: 홍길동", "홍길동"), ("어느교회(어느지방) 담임목사 홍길동", "홍길동"), ("", None),
    ], senior_pastor_of(F.col("v"), none))
    check(spark, [("홍길동 목사님", "홍길동"), ("홍길동, 김철수", None), ("홍길동(어디), 김철수(저기)", None), ("홍길동(임시당회장)", "홍길동"), ("홍길동담임목사님", "홍길동"), ("-", "이몽룡"), (" ", "이몽룡"), ("본문 참조", "이몽룡"), (None, "이몽룡")], senior_pastor_of(F.lit("담임목사 : 이몽룡"), F.col("v")))


PAGE = """<html><body><div class=v><script>x</script><p>one <b>two</b></p><p>three<br>four</p><!-- no --><table><tr><th>a<td>b</table>
<a class=m data-cfemail="1a7b5a7834796f">masked</a><img src="/i.png"><img src="data:image/png;base64,AA"><span style=x>deco</span></div>
<ul class=files><li><a href="/dl.php?f=a%20b.hwp">plan.hwp (1.2 MB)</a><li><a href="mailto:x@y">m</a><li><a href="/bbs/view_image.php?fn=/data/p.jpg"></a><li><a href="/down.do?file=c.pdf" title="x"></a></ul></body></html>"""


def test_html(spark):
    root = H.tree(PAGE)
    text = H.text_of(root.first("div.v"))
    assert text.startswith("one two\nthree\nfour") and "\nx" not in text and "a@b.cu" in text and "a\nb" in text
    markup = H.structure_of(root.first("div.v"))
    assert "<script" not in markup and "class" not in markup and "<b>" not in markup and "data:elided" in markup and "deco" in markup and "no" not in markup.split("four")[1][:12]
    assert H.images_of(root, "https://h/x/y")[0] == "https://h/i.png"
    assert H.attachments_of(root.first("ul.files"), "https://h/") == [("plan.hwp", "https://h/dl.php?f=a%20b.hwp"), ("/data/p.jpg", "https://h/data/p.jpg"), ("c.pdf", "https://h/down.do?file=c.pdf")]
    assert H.mail_of("zz") is None and H.mail_of("1a7b") is None
    check(spark, [("1a7b5a7834796f", "a@b.cu"), ("zz", None), ("1a7b", None), (None, None)], H.unmasked(F.col("v")))
    assert each(spark, [(None,), ("",)], H.normalized_text(F.col("v"))) == ["", ""]
    assert H.absolute("https://h", "http://[bad") is None


def test_html_of_any_depth(spark):
    deep = "<div>" * 20_000 + "far <b>down</b>" + "<o:p></o:p><small>low</small>"
    root = H.tree(deep)
    assert H.text_of(root).startswith("far downlow") and H.structure_of(root).count("<div>") == 20_000 and "o:p" not in H.structure_of(root) and "<small" not in H.structure_of(root)
    assert H.images_of(root, "https://h/") == [] and root.text() == "far downlow" and len(root.select("b")) == 1
    assert each(spark, [(deep,)], H.normalized_text(F.col("v"))) == ["far downlow"]
    assert H.attachments_of(H.tree("<a href='http://[bad'>x</a><a href='/a.pdf'></a>"), "https://h/") == [("a.pdf", "https://h/a.pdf")]


def test_urls(spark):
    check(spark, [("https://h/p?no=12&x=1", "12"), ("https://h/p", None), ("not a url", None), (None, None)], U.id_from_query(F.col("v"), "no"))
    check(spark, [("https://h/view/ab12.html", "ab12"), ("https://h/view/", None)], U.id_from_template(F.col("v"), "https://h/view/{id}.html"))
    check(spark, [("data:image/png;x", True), ("https://ok/i.png", True), ("https://r.example/i", False), ("https://ok/#https://r.example/x", False), ("ftp://x", False)], U.worth_fetching(F.col("v"), ["r.example"]))
    check(spark, [("https://h/l", "https://h/l?p=2"), ("https://h/l?a=1", "https://h/l?a=1&p=2")], U.page_request(F.col("v"), "p", F.lit(2)))


@pytest.mark.parametrize("name", ["pay_of", "clean_title"])
def test_rules_are_native(spark, name):
    plan = spark.range(1).select(getattr(T, name)(F.col("id").cast("string")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan
