import re

import pytest

from feedlake.llm import pii

KEY = "key of the tests"


def replaced(df):
    return {r["doc_id"]: r["text"] for r in pii.replace(df, KEY).collect()}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def mod97(iban):
    turned = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in turned)) % 97


@pytest.fixture(scope="module")
def out(docs):
    return replaced(docs(
        (1, "Mail Bob.Smith99@Mail.Example.com or BOB.SMITH99@MAIL.EXAMPLE.COM, bob.smith99@mail.example.com."),
        (2, "+1 (386) 555-3733 is 386-555-3733"),
        (3, "4944339490429605 and 4944 3394 9042 9605, not 9807915762804490"),
        (4, "10.1.2.3 8.8.8.8 999.1.1.1 v4.0. 1.2.3.4.5"),
        (5, "Mrs Anna Smith, Mr. Smith and Herr Klaus Smith; Mr Smith Mr Smith"),
        (6, "госпожа Анна Иванова, г-н Иванов; κυρία Ελένη Παπαδοπούλου"),
        (7, "GB82 WEST 1234 5698 7654 32, DE89370400440532013000, DE00370400440532013000; 078-05-1120"),
        (8, "The The 2024-01-15 12345 3.14 12:30 1,000,000 hello@ @home a@b"), (9, None), (10, "")))


def test_addresses(out):
    first, upper, lower = re.findall(r"\S+@[\w.]*\w", out[1])
    assert first == lower and upper == first.upper()
    assert re.fullmatch(r"[a-z]{3}\.[a-z]{5}\d{2}@[a-z]{4}\.[a-z]{7}\.com", lower)
    assert lower != "bob.smith99@mail.example.com"


def test_numbers_keep_their_format_and_stay_one_entity(out):
    phone, bare = re.fullmatch(r"\+1 (\(\d{3}\) \d{3}-\d{4}) is (\d{3}-\d{3}-\d{4})", out[2]).groups()
    assert re.sub(r"\D", "", phone) == bare.replace("-", "") != "3865553733"
    card, spaced = re.match(r"(\d{16}) and (\d{4} \d{4} \d{4} \d{4}),", out[3]).groups()
    assert card == spaced.replace(" ", "") != "4944339490429605" and card[0] == "4" and luhn(card)
    assert out[3].endswith("not 9807915762804490")


def test_networks(out):
    private, public, *rest = out[4].split(" ")
    assert re.fullmatch(r"10\.1\.\d\.\d", private) and private != "10.1.2.3"
    assert re.fullmatch(r"\d\.\d\.\d\.\d", public) and public != "8.8.8.8"
    assert rest == "999.1.1.1 v4.0. 1.2.3.4.5".split(" ")


def test_names(out):
    m = re.fullmatch(r"Mrs (\w+) (\w+), Mr\. (\w+) and Herr (\w+) (\w+); Mr (\w+) Mr (\w+)", out[5])
    she, *family, he = m[1], m[2], m[3], m[5], m[6], m[7], m[4]
    assert len(set(family)) == 1 and family[0] != "Smith"
    assert she.endswith(tuple(pii.ENDINGS["latin"]["given_f"].split()))
    assert he.endswith(tuple(pii.ENDINGS["latin"]["given_m"].split()))
    she, hers, his, greek = re.fullmatch(r"госпожа (\w+) (\w+), г-н (\w+); κυρία (\w+) \w+", out[6]).groups()
    assert hers.endswith(tuple(pii.ENDINGS["cyrillic"]["surname_f"].split()))
    assert his.endswith(tuple(pii.ENDINGS["cyrillic"]["surname_m"].split()))
    assert re.fullmatch("[а-я]+", she.lower()) and re.fullmatch("[ά-ώ]+", greek.lower())


def test_accounts(out):
    spaced, plain, wrong, number = re.fullmatch(r"(GB[\w ]+), (DE\w+), (DE\w+); ([\d-]+)", out[7]).groups()
    assert re.fullmatch(r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d", spaced)
    assert mod97(spaced.replace(" ", "")) == mod97(plain) == 1
    assert wrong == "DE00370400440532013000"
    assert re.fullmatch(r"\d{3}-\d\d-\d{4}", number) and number != "078-05-1120"


def iban(country, account):
    turned = "".join(str(int(c, 36)) for c in account + country + "00")
    return f"{country}{98 - int(turned) % 97:02d}{account}"


def test_accounts_before_upper_case_words_and_numbers(docs):
    unlisted = iban("XX", "12345678")
    spaced = " ".join(unlisted[i:i + 4] for i in range(0, 12, 4))
    new = replaced(docs(
        (1, "AT61 1904 3002 3457 3201 EUR 50"), (2, "AT611904300234573201 IN full"),
        (3, "ES91 2100 0418 4502 0005 1332 2024"), (4, "BE68 5390 0754 7034 AT61 1904 3002 3457 3201 GMBH"),
        (5, f"{spaced} EUR 50"), (6, "ES91 2100 0418 4502 0005 1332 4944339490429605")))
    first, = re.fullmatch(r"(AT\d\d(?: \d{4}){4}) EUR 50", new[1]).groups()
    packed, = re.fullmatch(r"(AT\d{18}) IN full", new[2]).groups()
    dated, = re.fullmatch(r"(ES\d\d(?: \d{4}){5}) 2024", new[3]).groups()
    belgian, again = re.fullmatch(r"(BE\d\d(?: \d{4}){3}) (AT\d\d(?: \d{4}){4}) GMBH", new[4]).groups()
    other, = re.fullmatch(r"(XX\d\d \d{4} \d{4}) EUR 50", new[5]).groups()
    before, card = re.fullmatch(r"(ES\d\d(?: \d{4}){5}) (\d{16})", new[6]).groups()
    found = {x.replace(" ", "") for x in (first, packed, dated, belgian, again, other, before)}
    assert len(found) == 4 and all(mod97(x) == 1 for x in found) and first == again and dated == before
    assert first != "AT61 1904 3002 3457 3201" and other != spaced and luhn(card) and card != "4944339490429605"
    assert not found & {"BE68539007547034", "ES9121000418450200051332"}


def test_clean_texts_stay(out):
    assert out[8] == "The The 2024-01-15 12345 3.14 12:30 1,000,000 hello@ @home a@b"
    assert out[9] is None and out[10] == ""


def test_surrogates_are_distinct_and_no_value_that_occurs(spark):
    # one digit per octet: so few addresses that most surrogates collide at first
    values = [f"{a}.{b}.1.1" for a in range(1, 10) for b in range(1, 10)]
    entities = spark.createDataFrame([("ip", v) for v in values], "type string, value string")
    rows = pii.surrogates(entities, KEY).collect()
    new = [r["surrogate"] for r in rows]
    assert sorted(r["value"] for r in rows) == sorted(values)
    assert len(set(new)) == len(new) and not set(new) & set(values)


def test_a_used_up_format_still_gives_distinct_surrogates(spark):
    values = [f"{a}.{b}.{c}.{d}" for a in "123456789" for b in "123456789" for c in "123456789" for d in "12345678"]
    entities = spark.createDataFrame([("ip", v) for v in values], "type string, value string")
    new = [r["surrogate"] for r in pii.surrogates(entities, KEY).collect()]
    assert len(set(new)) == len(values) and not set(new) & set(values)


def test_keys_differ_and_runs_agree(docs):
    df = docs((1, "a@b.org"), (2, "a@b.org"))
    one, again, other = (sorted(r["text"] for r in pii.replace(df, key=k).collect()) for k in "aab")
    assert one == again != other and one[0] == one[1]


def test_odd_rows_keep_their_columns(odd, empty):
    out = pii.replace(odd, KEY)
    assert out.columns == odd.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, odd.collect()))
    assert pii.replace(empty, KEY).collect() == []


def test_very_long_addresses(docs):
    labels = "x@" + "a." * 100_000 + "com"
    local = "b" * 200_000 + "@mail.org"
    new = replaced(docs((1, f"to {labels} or"), (2, f"to {local} or"), (3, "x@" + "a." * 100_000 + "1")))
    assert re.fullmatch(r"to \w@(?:\w\.){100000}com or", new[1]) and labels not in new[1]
    assert re.fullmatch(r"to \w{200000}@\w{4}\.org or", new[2]) and local not in new[2]
    assert new[3] == "x@" + "a." * 100_000 + "1"
