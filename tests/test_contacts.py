"""Contact rules: hand-made hits with the reason that the rule catalogue gives them."""

import pytest

from sievework.functions import contacts as C


@pytest.mark.parametrize(("value", "reason"), [
    ("zhang@163.com", ""), ("li.wei@corp.cn", ""), ("this@Main.run", "code suffix"), ("a@REALM.ORG", "upper-case domain"), ("user@corp.cn", "placeholder"), ("li@domain.com", "placeholder"), ("li@test.cn", "placeholder"),
    ("li@db.internal", "internal domain"), ("a" * 29 + "@corp.cn", "long local part"), ("buildbot7@corp.cn", "service local part"), ("wei.@corp.cn", "code reference"), ("liWei@corp.cn", "code reference"), ("hmac-x@corp.cn", "algorithm"),
    ("KLMN@corp.cn", "short code"), ("12.34@corp.cn", "number"), ("54f03dbd4382ec9101@corp.cn", "number"), ("li@lists.python.org", "service domain"), ("li@kernel-dev.cn", "list or meeting"), ("li@conference.cn", "list or meeting"),
    ("qwerty@corp.cn", "invented name"), ("your.name1@corp.cn", "invented name"), ("li@mytenant.cn", "template"), ("mymailid@corp.cn", "invented name"), ("firstnames@corp.cn", "template"), ("gcc@gcc.gnu.org", "public address"),
])
def test_address_reasons(value, reason):
    assert C.address_reason(value) == reason


@pytest.mark.parametrize(("text", "reason"), [
    ("ask {} soon", ""), ("ask '{}' soon", "delimited"), ("<td>{}</td>", "delimited"), ("x >{} soon", ""), ("a | {} | b", "table cell"), ("From {} soon", "header field"), ("please contact {} soon", "cue"), ("list.each {} soon", "code around"), ("a,{} soon", "delimited"),
])
def test_address_context(text, reason):
    start = text.index("{}")
    assert C.address_context(C.Hit(text.replace("{}", "li@corp.cn"), start, start + 10)) == reason


@pytest.mark.parametrize(("text", "reason"), [
    ("ring {} soon", ""), ("手机号 {} 谢谢", ""), ("({})", "code mark"), ("v {}.5", "code mark"), ("ring 421 {} soon", "number beside"), ("12 {} soon", "number beside"), ("timestamps {} soon", "code beside"), ("x{} soon", "part of a name"), ("-{} soon", "signed"),
    ("id 1ab2cd34 {}", "hexadecimal beside"), ("x = {}", "assigned"), ("a | {}", "table cell"), ("a -> b {} soon", "operator"), ("println {} soon", "identifier"), ("for example {} soon", "example"), ("heap {} soon", "resource"), ("cost 12.50 of {} soon", "decimal"),
    ("on 2024-01-02 to {} soon", "date or time"), ("to deadbeef and {} soon", "hexadecimal"), ("about 1e+5 of {} soon", "exponent"), ("run --count {}", "shell"), ("to 123456789012 and {} soon", "long number"), ("to 4711 and 4712 and {} soon", "several numbers"),
    ("{}  stack size", "resource label"),
])
def test_phone_reasons(text, reason):
    start = text.index("{}")
    assert C.phone_reason(C.Hit(text.replace("{}", "13912345678"), start, start + 11)) == reason
    assert C.phone_reason(C.Hit("ring 18001234567 soon", 5, 16)) == "service prefix"


def test_hits_of_a_column(spark):
    rows = [(1, "ask zhang@163.com or ring 13912345678 soon"), (2, "ask user@corp.cn, (13912345678)"), (3, ""), (4, None), (5, "😀 ring 13912345678 soon")]
    out = {r.id: r for r in C.with_personal(spark.createDataFrame(rows, "id int, prose string"), "prose").collect()}
    assert [(m.value, m.start) for m in out[1].emails] == [("zhang@163.com", 4)] and [(m.value, m.start) for m in out[1].phones] == [("13912345678", 26)]
    assert out[2].emails == out[2].phones == out[3].emails == [] and out[5].phones[0].start == 7
    assert not out[4].emails and not out[4].phones
