import re

from pyspark.sql import functions as F

from ledgermill.llm import pii_surrogates as q

DOCS = "doc_id long, text string"


def run(spark, texts, key="k"):
    docs = spark.createDataFrame(list(enumerate(texts)), DOCS)
    return {r.doc_id: r for r in q.replace(docs, key).collect()}


def luhn(text):
    digits = [int(c) for c in text if c.isdigit()][::-1]
    return sum(d if k % 2 == 0 else d * 2 % 10 + d // 5 for k, d in enumerate(digits)) % 10 == 0


def test_kinds_keep_their_format(spark):
    got = run(spark, [
        "a ann.lee42@mail5.example.com, bob@mail5.example.com.", "call +1 (743) 555-3824 or (212) 555-1234", "4111 1111 1111 1111 and 4785380592391139$$$",
        "host 193.195.198.107.", 'token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"', "123-45-6789", "DE89 3704 0044 0532 0130 00",
    ])
    assert [got[k].n_entities for k in range(7)] == [2, 2, 2, 1, 1, 1, 1]
    mails = re.fullmatch(r"a ([a-z]{3}\.[a-z]{3}\d\d)@([a-z]{4}\d\.[a-z]{7}\.com), ([a-z]{3})@(.*)\.", got[0].text)
    assert mails and mails[2] == mails[4]
    assert re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} or \(\d{3}\) \d{3}-\d{4}", got[1].text)
    first, second = re.fullmatch(r"(4\d{3} \d{4} \d{4} \d{4}) and (4\d{15})\$\$\$", got[2].text).groups()
    assert luhn(first) and luhn(second) == luhn("4785380592391139")
    assert all(int(x) < 256 for x in re.fullmatch(r"host (\d+)\.(\d+)\.(\d+)\.(\d+)\.", got[3].text).groups())
    assert re.fullmatch(r'token = "[0-9a-f]{40}"', got[4].text)
    assert re.fullmatch(r"\d{3}-\d{2}-\d{4}", got[5].text)
    assert re.fullmatch(r"DE\d\d( \d{4}){4} \d\d", got[6].text)
    for k, old in ((0, "ann.lee42"), (1, "555-3824"), (2, "4111 1111"), (3, "193.195"), (4, "24be6443"), (5, "123-45"), (6, "3704")):
        assert old not in got[k].text


def test_names_keep_gender_script_and_reference(spark):
    got = run(spark, ["Mrs. Ada Byron met Mr Byron. Later Ada Byron left.", "Frau Byron, DR", "господин Петр Иванов"])
    given, surname = re.fullmatch(r"Mrs\. (\w+) (\w+) met Mr \2\. Later \1 \2 left\.", got[0].text).groups()
    assert given.endswith("na") and "Byron" not in got[0].text
    assert got[1].text == f"Frau {surname}, DR"
    assert re.fullmatch(r"господин [А-Я][а-я]+н [А-Я][а-я]+", got[2].text) and "Иванов" not in got[2].text


def test_mentions_without_title(spark):
    got = run(spark, [
        "Contact John Smith at Main Street; Mr Smith.", "Dr. Mary Ann Lee came. Mary Ann Lee left, Lee's friend John Paul Lee too.\nThen Lee.", "Smith and John Smith, no title here", "Ms Smith, John Smith",
    ])
    given, surname = re.fullmatch(r"Contact (\w+) (\w+) at Main Street; Mr \2\.", got[0].text).groups()
    assert given.endswith("n") and (given, surname) != ("John", "Smith") and got[0].n_entities == 2
    drawn = re.fullmatch(r"Dr\. (\w+) (\w+) (\w+) came\. \1 \2 \3 left, \3's friend (\w+) (\w+) \3 too\.\n(\w+) \3\.", got[1].text).groups()
    assert not {"Mary", "Ann", "Lee", "John", "Paul"} & set(drawn)
    assert got[2].text == "Smith and John Smith, no title here"
    assert re.fullmatch(rf"Ms {surname}, \w+na {surname}", got[3].text)


def test_no_surrogate_is_a_real_value(spark):
    words = [("ssn", str(k)) for k in range(10)] + [("phone", f"+1 {k:02d}") for k in range(100)] + [("given-m", n) for n in ("Ann", "Bob")]
    out = q.surrogates(spark.createDataFrame(words, "kind string, entity string"), "k").collect()
    assert {(r.kind, r.entity) for r in out} == set(words) and len({(r.kind, r.surrogate) for r in out}) == len(words)
    assert not {(r.kind, r.surrogate) for r in out} & set(words)


def brute_force(texts, surrogate):
    """Entity by entity with the module's expressions, names by word; ``surrogate`` maps (kind, entity)."""
    import regex

    kinds = {k: regex.compile(rf"(?:{p})") for k, p in q.KINDS.items()}
    every = regex.compile("|".join(f"(?:{p})" for p in q.KINDS.values()))
    out = []
    for text in texts:
        def new(found):
            entity = found.group()
            kind = next((k for k, p in kinds.items() if p.fullmatch(entity)), "name")
            if kind == "email":
                box, domain = entity.split("@", 1)
                domain, top = domain.rsplit(".", 1)
                return f"{surrogate[('mailbox', box)]}@{surrogate[('domain', domain)]}.{top}"
            if kind != "name":
                return surrogate[kind, entity]
            title, *names = entity.split(" ")
            gender = next(g for g, ts in q.TITLES.items() if title.rstrip(".") in ts)
            return " ".join([title, *[surrogate[f"given-{gender}", n] for n in names[:-1]], surrogate["surname", names[-1]]])
        out.append(every.sub(new, text))
    return out


def test_equals_brute_force(spark):
    texts = [
        "mail a@b.com and c.d@b.com, Mrs. Ada Byron", "call +1 (743) 555-3824; Mr Petersen", "193.195.198.107 a@b.com Dr. Byron", "123-45-6789 and 123-45-6789", "x@y.z.org +1 (743) 555-3824", "none",
    ]
    entities = {("mailbox", "a"), ("domain", "b"), ("mailbox", "c.d"), ("given-f", "Ada"), ("surname", "Byron"), ("phone", "+1 (743) 555-3824"), ("surname", "Petersen"), ("ip", "193.195.198.107"), ("ssn", "123-45-6789"), ("mailbox", "x"), ("domain", "y.z")}
    drawn = {(r.kind, r.entity): r.surrogate for r in q.surrogates(spark.createDataFrame(sorted(entities), "kind string, entity string"), "k").collect()}
    got = run(spark, texts)
    assert [got[k].text for k in range(len(texts))] == brute_force(texts, drawn)


def test_clean_and_odd_rows_stay(spark):
    clean = ["Version 2.0 of 2024-01-05 costs 1,234,567.89 at 12:30", "", " \n", "Apache License, Version 2.0. 3rd", "x" * 200_000]
    got = run(spark, [*clean, None])
    assert [got[k].text for k in range(len(clean))] == clean and got[len(clean)].text is None
    assert {r.n_entities for r in got.values()} == {0}


def test_distinct_and_equal_everywhere(spark):
    ips = [f"10.{a}.{b}.{c}" for a in range(3) for b in range(20) for c in range(20)]
    got = run(spark, ["see " + i for i in ips] + ["again " + i for i in ips])
    first = [got[k].text.removeprefix("see ") for k in range(len(ips))]
    assert len(set(first)) == len(ips) and not set(first) & set(ips)
    assert first == [got[k + len(ips)].text.removeprefix("again ") for k in range(len(ips))]
    assert first != [r.text.removeprefix("see ") for k, r in sorted(run(spark, ["see " + i for i in ips], "other").items())]


def test_collisions_are_drawn_again(spark):
    words = spark.createDataFrame([("card", f"4{k:012d}") for k in range(10)] + [("mailbox", c) for c in "abcdefghijkl"], "kind string, entity string")
    out = q.surrogates(words, "k").collect()
    boxes = [r.surrogate for r in out if r.kind == "mailbox"]
    # twelve one-letter mailboxes leave fourteen letters that are not entities
    assert len(out) == 22 and len(set(boxes)) == 12 and not set(boxes) & set("abcdefghijkl")


def test_many_entities_in_one_text_and_clashing_columns(spark):
    text = " ".join(f"u{k % 50}@a.example.org" for k in range(3000))
    docs = spark.createDataFrame([(1, text), (1, text)], DOCS).withColumns({"_text": F.lit("t"), "_id": F.lit(9), "kind": F.lit("x"), "n_entities": F.lit("clash")})
    out = q.replace(docs, "k").collect()
    assert len(out) == 2 and out[0] == out[1] and out[0].n_entities == 3000 and out[0].kind == "x" and out[0]["_id"] == 9
    assert len(set(out[0].text.split())) == 50
    assert q.replace(docs.limit(0), "k").count() == 0


def test_used_up_formats_stay_distinct(spark):
    words = [("mailbox", c) for c in "abcdefghijklmnopqrstuvwxyz"] + [("ssn", str(k)) for k in range(10)]
    out = q.surrogates(spark.createDataFrame(words, "kind string, entity string"), "k").collect()
    assert {(r.kind, r.entity) for r in out} == set(words) and len(out) == 36
    assert len({(r.kind, r.surrogate) for r in out}) == 36 and all(r.entity != r.surrogate for r in out)
    assert all(len(r.surrogate) > 1 for r in out if r.kind == "mailbox")


def test_upper_case_secrets_and_possessives(spark):
    got = run(spark, ['TOKEN = "24BE64439E3E49CF46B2D7C90F3602A3D0B907FF"', "Mrs. Ada Byron's house; Ada Byron's; Ada Byronson", "Mrs. Ada Byron"])
    assert re.fullmatch(r'TOKEN = "[0-9A-F]{40}"', got[0].text) and "24BE" not in got[0].text
    whole = got[2].text.removeprefix("Mrs. ")
    assert got[1].text == f"Mrs. {whole}'s house; {whole}'s; Ada Byronson"


def test_addresses_of_any_script_are_replaced(spark):
    mails = [
        "محمد@مثال.com", "김철수@한국.kr", "やまだ@さくら.jp", "ヤマダー@サクラ.jp", "דוד@דוגמה.com", "राम.शर्मा@उदाहरण.com", "สมชาย@ตัวอย่าง.com", "ann김철@site한국.com",
        "Արամ@օրինակ.am", "١٢٣@مثال.com", "კი@ქართ.ge", "가@나.kr",
    ]
    texts = [f"to {m}, please" for m in mails]
    out = run(spark, texts)
    assert all(out[k].n_entities == 1 for k in range(len(mails)))
    new = [re.fullmatch(r"to (\S+), please", out[k].text)[1] for k in range(len(mails))]
    for old, mail in zip(mails, new):
        box, domain = old.rsplit(".", 1)[0].split("@")
        new_box, new_domain = mail.rsplit(".", 1)[0].split("@")
        assert box not in new_box and domain not in new_domain and len(new_box) >= len(box) and mail.endswith(old.rsplit(".", 1)[1])
        assert sum(a == b for a, b in zip(box + domain, new_box + new_domain) if a != ".") <= len(box + domain) // 2
    assert re.fullmatch(r"[\u0621-\u064a]{4}@[\u0621-\u064a]{4}\.com", new[0])
    assert re.fullmatch(r"[가-힣]{3}@[가-힣]{2}\.kr", new[1])
    assert re.fullmatch(r"[ぁ-ん]{3}@[ぁ-ん]{3}\.jp", new[2]) and re.fullmatch(r"[ァ-ヶ]{4}@[ァ-ヶ]{3}\.jp", new[3])
    assert re.fullmatch(r"[a-z]{3}[가-힣]{2}@[a-z]{4}[가-힣]{2}\.com", new[7])


def test_a_grown_candidate_never_holds_the_entity(spark):
    words = [("mailbox", c) for c in "abcdefghijklmnopqrstuvwxyz가나다라마바사아자차카타하고노도로모보소오조"]
    out = q.surrogates(spark.createDataFrame(words, "kind string, entity string"), "k").collect()
    assert len(out) == len(words) and not [r for r in out if r.entity in r.surrogate]
