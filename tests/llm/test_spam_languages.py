"""Languages that the corpus has little of, texts beyond all former bounds, and bounds per language."""

import random
from pathlib import Path

import pytest
from fareloom.llm.spam import Bounds, language_bounds, measure, page_measures, spam_shares

FOLDER = Path("/root/testdata/sf0.01")
PROSE = {
    "de": 'Ich habe den Wagen am Montag vom Hof geholt und seitdem läuft er ohne Probleme. Die Miete kostet jede Woche dreihundert Euro, also brauche ich vierzig Fahrten, bevor etwas übrig bleibt. Nächsten Monat sehen wir, was der Verwalter dazu sagt.',
    "fr": "J'ai pris la voiture lundi matin et depuis elle roule très bien. Le loyer me coûte trois cents euros par semaine, donc il me faut quarante courses avant de gagner quelque chose. Nous verrons le mois prochain ce que dit le responsable du dépôt.",
    "pl": 'Odebrałem samochód w poniedziałek i od tego czasu jeździ bez kłopotów. Czynsz kosztuje trzysta złotych tygodniowo, więc potrzebuję czterdziestu kursów, zanim cokolwiek zarobię. Zobaczymy w przyszłym miesiącu, co powie kierownik placu.',
    "fi": 'Hain auton maanantaina pihalta ja sen jälkeen se on kulkenut hyvin. Vuokra maksaa kolmesataa euroa viikossa, joten tarvitsen neljäkymmentä ajoa ennen kuin jää mitään käteen. Ensi kuussa nähdään, mitä varikon päällikkö asiasta sanoo.',
    "tr": 'Arabayı pazartesi günü avludan aldım ve o zamandan beri sorunsuz çalışıyor. Kira haftada üç yüz lira tutuyor, bu yüzden bir şey kazanmadan önce kırk sefer yapmam gerekiyor. Gelecek ay müdürün ne diyeceğini göreceğiz.',
    "pt": 'Peguei o carro na segunda-feira e desde então ele anda muito bem. O aluguel custa trezentos por semana, por isso preciso de quarenta corridas antes de ganhar alguma coisa. No próximo mês veremos o que diz o encarregado do pátio.',
    "sw": 'Nilichukua gari siku ya Jumatatu na tangu wakati huo linaenda vizuri sana. Kodi ni shilingi mia tatu kwa wiki, kwa hiyo nahitaji safari arobaini kabla sijapata chochote. Mwezi ujao tutaona msimamizi wa uwanja atasema nini kuhusu jambo hilo.',
    "hu": 'Hétfőn vettem át az autót a telepről, és azóta gond nélkül jár. A bérleti díj hetente háromszáz euró, ezért negyven fuvarra van szükségem, mielőtt bármit keresnék. Jövő hónapban meglátjuk, mit mond erről a telepvezető.',
    "vi": 'Tôi nhận xe vào thứ hai và từ đó đến nay xe chạy rất tốt. Tiền thuê mỗi tuần là ba trăm, vì vậy tôi cần bốn mươi chuyến trước khi kiếm được gì. Tháng sau chúng ta sẽ xem người quản lý bãi xe nói gì về việc này.',
    "id": 'Saya mengambil mobil itu pada hari Senin dan sejak itu jalannya baik sekali. Sewanya tiga ratus setiap minggu, jadi saya perlu empat puluh perjalanan sebelum mendapat apa pun. Bulan depan kita akan lihat apa kata kepala lapangan tentang hal ini.',
    "nl": 'Ik heb de auto maandag van het terrein gehaald en sindsdien rijdt hij zonder problemen. De huur kost driehonderd euro per week, dus ik heb veertig ritten nodig voordat ik iets verdien. Volgende maand zien we wat de beheerder ervan zegt.',
    "it": "Ho preso la macchina lunedì mattina e da allora va molto bene. L'affitto mi costa trecento euro alla settimana, quindi mi servono quaranta corse prima di guadagnare qualcosa. Il mese prossimo vedremo che cosa dice il responsabile del deposito.",
    "cs": 'Auto jsem si vyzvedl v pondělí a od té doby jezdí bez potíží. Nájem stojí tři sta korun týdně, takže potřebuji čtyřicet jízd, než něco vydělám. Příští měsíc uvidíme, co na to řekne správce dvora.',
    "sv": 'Jag hämtade bilen i måndags och sedan dess har den gått utan problem. Hyran kostar trehundra i veckan, så jag behöver fyrtio körningar innan jag tjänar något. Nästa månad får vi se vad föreståndaren säger om saken.',
    "tl": 'Kinuha ko ang sasakyan noong Lunes at mula noon ay maayos ang takbo nito. Tatlong daan ang upa bawat linggo, kaya kailangan ko ng apatnapung biyahe bago ako kumita ng kahit ano. Sa susunod na buwan makikita natin kung ano ang sasabihin ng tagapamahala.',
}
LISTS = {
    "russian": "аренда такси, дешёвая машина, бонус водителю, прокат авто, выкуп, залог, скидка, парк, смена, тариф комфорт, аэропорт, гибрид, лизинг",
    "japanese": "タクシー 格安 レンタル 中古車 割引 配車 空港 送迎 運転手 募集 リース 保証金 不要 乗務員 特典 燃費 新車 月額 定額 車両",
    "english": "taxi lease deal, cheap hybrid rental, driver bonus, weekly fee discount, used cars, airport ride, comfort car, no deposit, fleet discount, lease to own, low mileage, city shift",
}
KEPT = {
    "russian": "Машина стоит во дворе с понедельника, и никто не знает, когда её заберут. Сменщик сказал, что отчёт придёт вечером, а страховка уже оплачена.",
    "japanese": "月曜日に車庫から車を受け取ってから、ずっと調子がよいです。毎週の料金を払うので、四十回ほど走らないと手元に残りません。来月には担当者の話を聞いてみるつもりです。",
    "ukrainian": "Машина стоїть у дворі з понеділка, і ніхто не знає, коли її заберуть. Змінник сказав, що звіт прийде ввечері, а страховку вже сплачено.",
}


@pytest.mark.skipif(not FOLDER.exists(), reason="needs the test tables")
def test_writing_in_any_language_is_kept_and_lists_are_found(spark):
    want = {-1 - i: (f"{k} prose", False, t) for i, (k, t) in enumerate((PROSE | KEPT).items())} | {-100 - i: (f"{k} list", True, t) for i, (k, t) in enumerate(LISTS.items())}
    own = spark.createDataFrame([(i, t) for i, (_, _, t) in want.items()], "doc_id bigint, text string")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").unionByName(own)
    got = {r.doc_id: r.spam for r in spam_shares(docs).where("doc_id < 0").collect()}
    assert {name: got[i] for i, (name, _, _) in want.items()} == {name: spam for name, spam, _ in want.values()}


def test_a_corpus_without_known_languages_is_judged_without_words(spark):
    docs = spark.createDataFrame(list(enumerate(PROSE.values())) + [(99, "günstig taxi mieten wagen bonus " * 20)], "doc_id bigint, text string")
    assert {r.doc_id for r in spam_shares(docs).where("spam").collect()} == {99}


def verdicts(spark, *texts):
    return [r.spam for r in sorted(spam_shares(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect(), key=lambda r: r.doc_id)]


INTRO = "I took the car over from the owner on Monday and it has been cheap ever since, so I shall keep it for now."


def test_no_bound_on_the_length_of_links_and_lines(spark):
    anchor = f'<a href="http://x.test/{"p" * 3000}">' + "used taxi deal " * 60 + "</a>"
    bracket = f"[{'used taxi lease ' * 40}](https://x.test/{'q' * 3000})"
    assert verdicts(spark, INTRO + "\n" + anchor, INTRO + "\n" + bracket) == [True, True]
    lines = "so I went on about the yard and the car that I had\n" * 500
    assert len(measure(lines)) == 1


def test_short_pages_of_links_are_found_and_bare_titles_are_not(spark):
    assert verdicts(spark, "https://a.test/p/1", "https://a.test/p/1\nhttps://b.test/p/2", "#CheapTaxi #UsedCar #Lease", "Tips?", "VM-014", "gracias", "Weekly lease statement") == [True, True, True, False, False, False, False]
    assert verdicts(spark, "taxi lease | used | fee | cab | car", "taxi used taxi, taxi fee, taxi, taxi") == [True, True]


def test_the_mark_of_a_link_in_a_text_is_a_blank(spark):
    plain = measure("See \u0001 \u0001 \u0001 here now\n" + "\n".join(f"https://a{i}.test/x" for i in range(3)))
    assert sum(x[7] for x in plain) == 3 and plain[0][6] == 0 and all(x[6] > 0 for x in plain if x[7])


def test_bounds_follow_the_language(spark):
    rnd = random.Random(3)
    usual = [f"the {rnd.choice(['car', 'yard', 'fee'])} is on the list for {i} of us and it was sold." for i in range(60)]
    listed = ["el coche | la cuota | es de | un patio | por día | con seguro | y sin | más nada." for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(usual + listed)), "doc_id bigint, text string")
    got = {r.lang: r.asDict() for r in language_bounds(page_measures(docs).where("counted is null")).collect()}
    assert got["en"]["separators"] == Bounds().separators < got["es"]["separators"] and Bounds().low <= got["en"]["missing"] <= Bounds().high
