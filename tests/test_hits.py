"""The table of all personal-data hits."""

from sievework.plans import hits

CARD, PHONE = "4929123412341235", "13912345678"


def luhn_valid(digits):
    odd = [int(c) for c in digits[::-1]]
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(odd)) % 10 == 0


def found(spark, texts, **more):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    return {(r.k, r.kind, r.start): (r.masked, r.context, r.reason) for r in hits.all_hits(df, "text", ["k"], **more).collect()}


def test_every_hit_has_its_place_and_its_reason(spark):
    card = next(str(4929123400000000 + i) for i in range(37, 99) if luhn_valid(str(4929123400000000 + i)))
    wrong = card[:-1] + str((int(card[-1]) + 1) % 10)
    texts = [
        f"my credit card is {card} and not {wrong} ok", f"array {card} of numbers", "visa 4111111111111111 card", "visa 4444444444444448 card",
        "write to jane.miller@corpmail.org soon", "write to a@example.com", "reach jo.ann@corpmail.org, li.wei@corpmail.org and al.bo@corpmail.org there",
        "id 110105199003071234 here", "id 990105199003071234 here", "id 110105199003071234 on 2024-01-02 here",
        "the host 192.168.77.5 answers", "see `192.168.77.5`", "example: 192.168.77.5", "on my network 192.168.77.5 is down", "net 192.168.1.7 is plain",
        "微信号: abc12345 加我", "微信号: xxxxx1 加我", None, "", "nothing here",
    ]
    got = found(spark, texts)
    reason = lambda k, kind: [v[2] for (x, y, _), v in sorted(got.items()) if (x, y) == (k, kind)]
    assert reason(0, "bank_card") == ["", "check digit"] and reason(1, "bank_card") == ["no payment word"]
    assert reason(2, "bank_card") == ["test number"] and reason(3, "bank_card") == ["plain pattern"]
    assert got[0, "bank_card", 18][:2] == (f"{card[:4]}XXXXXXXX{card[-4:]}", f"my credit card is {card[:4]}XXXXXXXX{card[-4:]} and not {wrong} ok")
    assert reason(5, "email") == ["not a real address"] and got[4, "email", 9][0] == "xxxxxx@corpmail.org"
    assert len(reason(6, "email")) == 3 and all(reason(6, "email"))
    assert reason(7, "id_card") == [""] and reason(8, "id_card") == ["province"] and reason(9, "id_card") == ["date or time near"]
    assert got[7, "id_card", 3][0] == "110105XXXXXXXX1234"
    assert [reason(k, "private_ip") for k in range(10, 15)] == [[""], ["inline code"], ["example"], ["own network"], ["documentation net"]]
    assert got[10, "private_ip", 9][0] == "192.168.x.x"
    assert reason(15, "social") == [""] and reason(16, "social") == ["masked"]
    assert not [k for k in got if k[0] >= 17]


def test_contexts_are_cut_to_one_line(spark):
    text = "a" * 70 + "\nvisa 4111111111111111 card\n" + "b" * 70
    (masked, context, _), = found(spark, [text]).values()
    assert context == "…" + "a" * 54 + "⏎visa " + masked + " card⏎" + "b" * 54 + "…"


def test_hits_that_count_are_those_of_the_rules(spark):
    """What has no reason is what the dialogue rule flags, kind by kind."""
    from pyspark.sql import functions as F

    from sievework.functions import contacts, pii

    texts = ["write to jane.miller@corpmail.org soon", "call 13912345678 now", "call me, 13912345678 is mine", "credit card 4929123400000000", "ip 192.168.77.5 and 172.17.0.1", "id 110105199003071234 here"]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    got = {(r.k, r.kind, r.start) for r in hits.all_hits(df, "text", ["k"]).filter("reason = ''").collect()}
    d = contacts.with_personal(df, "text")
    c = F.col("text")
    want = set()
    for kind, col in (("email", F.col("emails")), ("phone", F.col("phones")), ("id_card", pii.id_cards(c)), ("bank_card", pii.bank_cards(c)), ("private_ip", F.filter(pii.private_ips(c), lambda m: ~contacts.configured_ip(m)))):
        want |= {(r.k, kind, m.start) for r in d.select("k", col.alias("m")).collect() for m in r.m}
    assert got == want


def test_hit_queries_match_their_oracles(same_rows):
    for name, sql in hits.ORACLE_SQL.items():
        same_rows(hits.QUERIES[name], sql)
