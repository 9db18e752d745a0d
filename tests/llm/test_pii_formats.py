"""Formats of personal data: replaced in their own shape, linked where equal, turned back."""

import datetime as dt
import re

TEXTS = [
    "at 2024-03-01T10:00:00Z and 2024-03-01, 01/03/2024, 01.03.2024", "call (555) 123-4567, 555-123-4567 or +1 555 123 4567.",
    "+14155552671 is +1 415 555 2671 and +1-415-555-2671", "ssn 123-45-6789, not 666-45-6789, 000-45-6789 or 123-00-6789",
    "iban DE89 3704 0044 0532 0130 00, GB29NWBK60161331926819, not DE88 3704 0044 0532 0130 00", "on 12/25/2023 and 13/13/2023 and 31/12/2199",
    "+358 40 1234567 +4930901820 version 1.2.3 10.20.30 5551234567 1-555-123-4567-8", "02/30/2024 30/02/2024 02/29/2023 12/31/2024",
]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def iban_ok(text):
    flat = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in flat[4:] + flat[:4])) % 97 == 1


def test_formats(spark):
    from sparktrail.llm.pii import pseudonyms

    out = pseudonyms(frame(spark, TEXTS), "k")
    got = {r.doc_id: r for r in out.collect()}
    iso, same, slashed, dotted = re.fullmatch(r"at (\S+)T10:00:00Z and (\S+), (\S+), (\S+)", got[0].text).groups()
    day = dt.date.fromisoformat(iso)
    assert iso != "2024-03-01" and same == iso and slashed == day.strftime("%d/%m/%Y") and dotted == day.strftime("%d.%m.%Y")
    a, b, c = re.fullmatch(r"call (\(\d{3}\) \d{3}-\d{4}), (\d{3}-\d{3}-\d{4}) or \+1 (\d{3} \d{3} \d{4})\.", got[1].text).groups()
    assert len({re.sub(r"\D", "", x) for x in (a, b, c)}) == 1 and "123-4567" not in a
    numbers = re.findall(r"\+[\d -]+\d", got[2].text)
    assert len(numbers) == 3 and len({re.sub(r"\D", "", x) for x in numbers}) == 1 and numbers[0] != "+14155552671"
    assert re.fullmatch(r"ssn (?!123-45-6789)\d{3}-\d{2}-\d{4}, not 666-45-6789, 000-45-6789 or 123-00-6789", got[3].text)
    first, second = re.match(r"iban (DE[\d ]+), (GB\d\dNWBK\d{14}), not DE88 3704 0044 0532 0130 00$", got[4].text).groups()
    assert iban_ok(first) and iban_ok(second) and "3704 0044" not in first and len(first) == 27
    assert re.fullmatch(r"on (?!12/25/2023)\d\d/\d\d/\d{4} and 13/13/2023 and (?!31/12/2199)\d\d/\d\d/\d{4}", got[5].text)
    assert got[6].text.startswith("+358 ") and " version 1.2.3 10.20.30 5551234567 1-555-123-4567-8" in got[6].text
    assert got[7].text == TEXTS[7].replace("x", "x")  # no dates, or days that stay
    back = pseudonyms(out, "k", restore=True)
    assert [r.text for r in back.orderBy("doc_id").collect()] == TEXTS


def test_formats_permute(spark):
    """Different values stay different, and all are turned back."""
    from sparktrail.llm.pii import pseudonyms

    start = dt.date(2000, 1, 1)
    days = [start + dt.timedelta(days=i) for i in range(800)]
    for texts in ([d.strftime("%d/%m/%Y") for d in days], [d.strftime("%m/%d/%Y") for d in days],
                  [f"{a:03d}-{g:02d}-{s:04d}" for a in (1, 665, 667, 899) for g in (1, 99) for s in range(1, 40)],
                  [f"+44 20 {n:08d}" for n in range(300)]):
        df = frame(spark, texts)
        out = pseudonyms(df, "k")
        assert out.select("text").distinct().count() == len(set(texts))
        assert [r.text for r in pseudonyms(out, "k", restore=True).orderBy("doc_id").collect()] == texts
