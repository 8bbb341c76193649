import time

import pytest

from fareloom.llm.spam import measure, spam_shares

HONEST = {
    "en": "I took the car over from the owner on Monday and it has been cheap ever since. They charge me $324 a week, so I need 44 trips before I earn anything. After 23 weeks I cleared a bit, and we shall see next month what the yard says about it.",
    "es": "Dejé el coche el lunes porque faltaban híbridos en el patio. Según la encargada, la cuota cambia antes del amanecer. Mi coche hizo 286 millas y gasté 22 dólares al día en combustible, pero no me quejo de nada.",
    "ko": "비가 오던 날 받은 차는 생각보다 조용했습니다. 주당 $623를 내기 때문에 27건은 운행해야 남습니다. 신규 기사 말로는 조건이 곧 바뀐다고 합니다. 정산 금액이 다르면 주행 거리 항목부터 살펴보세요.",
}
SPAM = {
    "keywords": "cheap car rental taxi lease driver bonus " * 30,
    "shuffled": "fee car to used rental car comfort own lease fee used driver taxi cheap taxi lease to rental low cheap car bonus used comfort " * 4,
    "sentences": "Best used taxi and used taxi for low fee rental. Get used taxi, get used taxi, love used taxi. Why taxi lease? taxi lease means taxi lease. " * 6,
    "links": "\n".join(f"https://a{i}.example/p/{i}" for i in range(20)),
    "broken links": " | ".join(f"shop{i}[.]test/offer" for i in range(20)),
    "anchors": "".join(f'<li><a href="http://x{i}.test/">hybrid taxi</a></li>' for i in range(20)),
    "hashtags": " ".join(f"#CheapTaxi{i}" for i in range(30)),
    "menus": "\n".join("Home > Deals > Used Taxi > Cars > Login > Orchard Gate" for _ in range(12)),
    "tags": "\n".join(f"brand=TORREVA; model=COVE; sku=A{i}; tag=hybrid taxi; tag=lease to own" for i in range(12)),
    "words a line": "\n".join(["taxi lease", "driver bonus", "rent a cab", "lease to own"] * 8),
    "korean": "택시 리스 기사 보너스 리스 특가 중고 택시 저렴한 렌트 " * 12,
    "spanish": "alquiler de taxi, renta de flota, coche cómodo, sin fianza, " * 15,
}


@pytest.fixture(scope="module")
def verdicts(spark):
    rows, want = [], {}
    for name, text in SPAM.items():
        rows.append((name, text))
        want[name] = True
        rows.append((f"{name} after a sentence", HONEST["en"][:80] + "\n" + text))
        want[f"{name} after a sentence"] = True
    for lang, text in HONEST.items():
        extra = {
            "": "", "links": "\n\nSee also:\n- https://a.example/p/1\n- https://b.test/x", "tags": "\n#CheapTaxi #UsedCar", "table": "\n\n| model | fee |\n| --- | --- |\n| Cove | 606 |",
            "line": "\n" + "=" * 400, "letters": " " + "a" * 500, "invisible": "",
        }
        for name, more in extra.items():
            body = "​".join(text) if name == "invisible" else text
            rows.append((f"{lang} {name}", body + more))
            want[f"{lang} {name}"] = False
        rows.append((f"{lang} twice", text + "\n" + text))
        want[f"{lang} twice"] = False
    rows.append(("russian", "Машина стоит во дворе с понедельника, и никто не знает, когда её заберут. Сменщик сказал, что отчёт придёт вечером, а страховка уже оплачена."))
    want["russian"] = False
    rows.append(("russian keywords", "аренда такси дешево аренда такси бонус " * 20))
    want["russian keywords"] = True
    for i, short in enumerate([None, "", "  \n", "ok", "Tips?", "🚕", "VM-014"]):
        rows.append((f"short {i}", short))
        want[f"short {i}"] = False
    names = [n for n, _ in rows]
    df = spark.createDataFrame([(i, t, "x") for i, (_, t) in enumerate(rows)], "doc_id bigint, text string, share string")
    got = {names[r.doc_id]: r.spam for r in spam_shares(df).collect()}
    return want, got


def test_pages_are_found_and_posts_are_not(verdicts):
    want, got = verdicts
    assert {n for n in want if want[n] != got[n]} == set()


def test_one_row_per_document_and_empty_tables(spark):
    df = spark.createDataFrame([(1, SPAM["keywords"]), (1, SPAM["keywords"]), (None, SPAM["links"])], "doc_id bigint, text string")
    assert sorted((r.doc_id or 0, r.spam) for r in spam_shares(df).collect()) == [(0, True), (1, True), (1, True)]
    assert spam_shares(df.limit(0)).count() == 0


def test_measures_of_nothing():
    assert measure(None) == [] and measure(" \n") == []


def test_very_long_texts_take_proportional_time():
    n = 200_000
    for text in ("a" * n, "a-" * n, "<a " * n, "[x" * n, "((" * n, "a." * n, "x dot " * n, "|" * n, "/ " * n, "#" * n, "http://" * n, ">" * n, "한" * n, ". " * n, "\n" * n, "www." * n):
        began = time.process_time()
        measure(text)
        assert time.process_time() - began < 20, text[:10]
