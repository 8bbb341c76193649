from fareloom.llm.spam import spam_shares

HONEST = "I took the car over from the owner on Monday and it has been cheap ever since. They charge me $324 a week, so I need 44 trips before I earn anything. After 23 weeks I cleared a bit, and we shall see next month what the yard says about it. I have no more to say on this for now."
LONG = "\n".join("https://shop.example/" + f"{i}offer" + "usedtaxilease" * 4 for i in range(10))


def verdicts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id: r.spam for r in spam_shares(df).collect()}


def test_links_and_anchors_count_in_full(spark):
    anchors = "".join(f'<li><a href="http://x{i}.test/{"usedtaxilease" * 4}">hybrid taxi</a></li>' for i in range(10))
    assert verdicts(spark, [HONEST + "\n" + LONG, HONEST + "\n" + anchors, HONEST + "\n" + LONG.split("\n")[0]]) == {0: True, 1: True, 2: False}


def test_runs_of_one_letter_outweigh_nothing(spark):
    assert verdicts(spark, [HONEST + "\n" + "a" * 5000, HONEST + "\n" + "Ab" + "B" * 900, "soooooooooooooooooooooooo " + HONEST]) == {0: False, 1: False, 2: False}
