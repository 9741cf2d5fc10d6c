import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from gridloom.llm import decontaminate as dc
from gridloom.llm import line_dedup as ld
from gridloom.llm import quality_rules as qr
from gridloom.llm import surrogates as pii
from gridloom.llm import url_filters as uf


def test_urls_and_trie_against_every_rule(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("b.example.net", "/en", "block"), ("org", "/fr/", "allow"), ("x.org", "", "block"), ("org", "/frx", "block")]
    hosts = ["net", "example.net", "B.Example.NET", "a.b.example.net", "x.org", "y.x.org", "xx.org", "notnet", ""]
    paths = ["", "/", "/en", "/en/", "/english/x", "/fr/", "/fr/a", "/frx", "/de"]
    urls = [f"http://{h}{p}{q}" for h in hosts for p in paths for q in ("", "?a=/en/", "#/fr/")] + [None, "", "no url", "://", "http://net:80/x", "ftp://u@net/a://b"]
    pages = spark.createDataFrame([(i % 50 if i else None, u, "x") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = uf.judge(pages, rules).collect()
    assert sorted(map(str, got)) == sorted(map(str, uf.judge_joined(pages, spark.createDataFrame(rules, "host string, path string, verdict string")).collect()))
    assert len(got) == len(urls)
    for r in got:
        fits = [(len(h + p), v, h + p) for h, p, v in rules if (r["host"] == h or r["host"].endswith("." + h)) and r["path"].startswith(p)]
        want = max(fits, default=(0, "allow", None))
        assert (r["rule"], r["verdict"]) == (want[2], want[1])
    odd = [("z.net", "/b/", "block"), ("net", "/b/cd", "BLOCK"), ("net", "/b/c", "Allow"), ("net", "/b/c", "block"), ("net", "", "block"), (None, "/", "block"), ("org", None, "block"), ("a.net", "/", "allow"), ("net", "/ab", "allow")]
    urls = ["http://z.net/b/cd", "http://ends..net/x", "http://..net", "http://x.org/", "http://a.net/ab", "http://net/b/c"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    first = uf.judge(pages, odd).collect()
    second = uf.judge_joined(pages, spark.createDataFrame(odd, "host string, path string, verdict string")).collect()
    assert sorted(map(str, first)) == sorted(map(str, second))
    assert [(r["rule"], r["verdict"]) for r in sorted(first)] == [("z.net/b/", "block"), ("net", "block"), ("net", "block"), (None, "allow"), ("net/ab", "allow"), ("net/b/c", "block")]
    assert uf.judge(pages.where("1 = 0"), rules).count() == 0 and {r["verdict"] for r in uf.judge(pages, []).collect()} == {"allow"}


def test_ledger_of_odd_rows(odd_docs, no_docs):
    rows = qr.ledger(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r, text in zip(rows, [x["text"] for x in odd_docs.collect()]):
        words = (text or "").split()
        grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        seen = Counter(grams)
        assert r["n_words"] == len(words) and r["n_repeat_words"] == len({i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)})
    assert qr.ledger(no_docs).count() == 0


def test_ablations_from_bits(spark, odd_docs, no_docs):
    rows = qr.ledger(odd_docs)
    bits = [r["failure_bits"] for r in rows.collect()]
    got = {(r["policy"], r["rule"]): (r["rejected"], r["only_by_rule"], r["kept_without"]) for r in qr.ablations(rows).collect()}
    for policy, rules in qr.POLICIES.items():
        for rule in rules:
            m, b = qr.mask(rules), qr.mask([rule])
            assert got[policy, rule] == (sum(bool(x & m) for x in bits), sum(x & m == b for x in bits), sum(x & m & ~b == 0 for x in bits))
    assert {tuple(r)[2:] for r in qr.ablations(qr.ledger(no_docs)).collect()} == {(0, 0, 0)}


def test_lines_of_odd_rows(odd_docs, no_docs):
    out = ld.dedup_lines(odd_docs, min_documents=3)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and out.columns[: len(odd_docs.columns)] == odd_docs.columns
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append((r["text"], r["__n_lines"], r["__n_dropped"]))
    assert by_id[1] == [("", 1, 1)] * 2 and by_id[2] == by_id[8] == [("", 1, 1)]
    assert by_id[6] == [("\n\n", 3, 0)] and by_id[3] == by_id[4] == [("", 1, 0)]
    assert sorted(by_id[None]) == [("", 1, 0), ("Only one here", 1, 0)]
    assert by_id[7] == [("Été naïve\nAlpha beta\nAlpha beta", 3, 0)]
    assert ld.dedup_lines(no_docs).count() == 0


def test_lines_count_documents(spark):
    """Rows of one id are one document; rows without an id are one if their texts are equal."""
    rows = [(1, f"{i}\none id") for i in range(10)] + [(None, "equal rows")] * 10 + [(None, f"{i}\nno id") for i in range(10)] + [(i, " Many\t") for i in range(2, 12)] + [(1, "many")]
    got = [tuple(r) for r in ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "text").collect()]
    want = [(1, f"{i}\none id") for i in range(10)] + [(None, "equal rows")] * 10 + [(None, f"{i}") for i in range(10)] + [(i, "") for i in range(1, 12)]
    assert sorted(map(str, got)) == sorted(map(str, want))


ITEM = "A train leaves Paris at 9 km per hour with 120 people and reaches London after 7 hours how many people are in it"


def test_templates_find_copies_and_new_numbers(spark, odd_docs, no_docs):
    filler = "some other words that say nothing at all about it "
    docs = [
        (1, filler + ITEM + " " + filler), (2, filler + ITEM.replace("9", "15").replace("120", "44").replace("London", "Rome")),
        (3, filler * 5), (4, None), (5, ""), (6, " ".join(ITEM.split()[:6])), (None, ITEM.upper()), (1, filler + ITEM + " " + filler),
    ]
    bench = spark.createDataFrame([(10, ITEM, 1), (11, ITEM, 2), (12, None, 3), (13, "too short", 4), (14, "five words are just enough", 5)], "item_id long, text string, doc_id int")
    frame = spark.createDataFrame([(d, t, 0, "y") for d, t in docs], "doc_id long, text string, item_id int, h string")
    got = {(r["doc_id"], r["item_id"]): r for r in dc.contaminated(frame, bench).collect()}
    assert {(1, 10), (2, 10)} <= set(got) <= {(1, 10), (2, 10), (None, 10)}
    assert got[2, 10]["n_slots"] > 0 and got[2, 10]["agreement"] >= dc.MIN_AGREEMENT and got[1, 10]["agreement"] == 1.0
    assert dc.contaminated(no_docs, bench).count() == 0 and dc.contaminated(frame, bench.where("1 = 0")).count() == 0
    assert dc.contaminated(odd_docs, bench).count() == 0


def test_slots_that_contradict_are_no_match(spark):
    item = "if x has 3 and y has 3 and z has 3 and w has 3 and v has 3 then all have 3"
    other = item
    for n in (4, 5, 6, 7, 8, 9):
        other = other.replace("3", str(n), 1)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = spark.createDataFrame([(1, item.replace("3", "8")), (2, other)], "doc_id long, text string")
    assert [r["doc_id"] for r in dc.contaminated(docs, bench).collect()] == [1]


def test_items_of_one_template_and_repeated_copies(spark):
    """Every item of a template is compared, at every place where its windows line up."""
    item = "if x has 3 and y has 3 and z has 3 and w has 3 and v has 3 then all have 3"
    other = item
    for n in (4, 5, 6, 7, 8, 9):
        other = other.replace("3", str(n), 1)
    bench = spark.createDataFrame([(1, item), (2, other)], "item_id long, text string")
    docs = spark.createDataFrame([(1, item), (2, other), (3, f"{other} . {item}")], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(docs, bench).collect()}
    assert got == {(1, 1), (2, 2), (3, 1), (3, 2)}
    first = bench.where("item_id = 1")
    assert [r["doc_id"] for r in dc.contaminated(docs, first).orderBy("doc_id").collect()] == [1, 3]


def test_long_passages_and_short_items(spark):
    """A passage below half of its item counts by its length, an item of few words if all its words are there."""
    long = " ".join(f"{a}{b}" for a in "bcdfghjk" for b in "aeiouwy") + " ending here now"
    taken = long.split()[10:35]
    numbers = " ".join(str(n * n) for n in range(3, 23))
    bench = spark.createDataFrame([(1, long), (2, "Who was Kepler?"), (3, numbers + " " + " ".join(reversed(long.split()))), (4, "at 7")], "item_id long, text string")
    filler = "other words that say nothing of it"
    docs = [
        (1, f"{filler} {' '.join(taken)} {filler}"), (2, f"{filler} who was Kepler {filler}"), (3, f"{filler} {' '.join(taken[:12])} {filler}"), (4, " ".join(str(n + 90) for n in range(40))),
        (5, "who was Galilei and kepler was who"), (6, f"{filler} {numbers} {filler}"), (7, "at 8 or at 9"), (8, "not at 7"),
    ]
    got = {(r["doc_id"], r["item_id"]) for r in dc.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert got == {(1, 1), (2, 2), (6, 3), (8, 4)}


def test_leaks_against_brute_force(spark, sf_dir):
    got = {(r["doc_id"], r["item_id"]) for r in dc.op7_benchmark_decontamination(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    want = {(d["doc_id"], i["item_id"]) for d in docs for i in items if i["text"] in d["text"]}
    assert want <= got
    words = {d["doc_id"]: set(d["text"].lower().split()) for d in docs}
    texts = {i["item_id"]: set(i["text"].lower().split()) for i in items}
    assert all(len(words[d] & texts[i]) >= 0.5 * len(texts[i]) for d, i in got - want)


MIXED = 'Mr Peter Miller wrote to anna.k@mail.example.com, token = "00ff12ab00ff12ab"; call +1 (437) 555-0689 or 10.1.2.3, card 4111 1111 1111 1111. Ms Miller: ANNA.K@MAIL.EXAMPLE.COM.'


def test_surrogates_keep_kind_and_identity():
    text, n = pii.replaced(MIXED, {})
    assert n == 8 and text != MIXED
    for value in ("Peter", "Miller", "anna.k", "00ff12ab", "555-0689", "10.1.2.3", "4111 1111"):
        assert value not in text
    a, b = (text[x:y] for x, y, k in pii.entities(text) if k == "email")
    assert a.upper() == b
    card = next(text[x:y] for x, y, k in pii.entities(text) if k == "card")
    digits = card.replace(" ", "")
    assert [len(p) for p in card.split(" ")] == [4] * 4 and pii._luhn(digits[:-1]) == int(digits[-1])
    given, family = next(text[x:y] for x, y, k in pii.entities(text) if k == "name").split(" ")
    assert given in pii.GIVEN_NAMES["latin", "m"] and f"Ms {family}" in text
    assert pii.replaced(MIXED, {})[0] == text and pii.replaced(MIXED, {})[0] != pii.replaced(MIXED, {("ip", "10.1.2.3"): 1})[0]


def test_formats_of_account_and_phone_numbers():
    ibans = [
        "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819", "GB29 NWBK 6016 1331 9268 19", "NL91ABNA0417164300", "NL91 ABNA 0417 1643 00",
        "FR1420041010050500013M02606", "FR14 2004 1010 0505 0001 3M02 606", "IT60X0542811101000000123456", "AT611904300234573201", "AT61 1904 3002 3457 3201",
        "NO9386011117947", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S", "BE68 5390 0754 7034",
    ]
    phones = [
        "+44 20 7946 0958", "+33 6 12 34 56 78", "+49 30 12345678", "+34 612 34 56 78", "+7 495 123-45-67", "+1 (437) 555-0689", "+442079460958", "+49 (0)30 1234-5678", "+1.437.555.0689",
        "+49 171 123 456 78", "(437) 555-0689", "437-555-0689",
    ]
    for kind, values in (("iban", ibans), ("phone", phones)):
        for value in values:
            for text in (value, f"see {value}, please", f"({value})", f"{value} OR so"):
                assert [(text[a:b], k) for a, b, k in pii.entities(text)] == [(value, kind)], text
                out = pii.replaced(text, {})[0]
                assert value not in out and len(out) == len(text) and [(b - a, k) for a, b, k in pii.entities(out)] == [(len(value), kind)]
    text = "+1 (437) 555-0689 4111 1111 1111 1111"
    assert [k for _, _, k in pii.entities(text)] == ["phone", "card"]
    assert pii.entities("AB12 no number, +12 34 neither, DE89 3704") == []


def test_scripts_and_signs(spark):
    """Addresses in any script, of signs only, and digits of other scripts: replaced in their form, and nothing ends the job."""
    arabic = "".join(chr(0x660 + int(c)) if c.isdigit() else c for c in "+44 20 7946 0958")
    values = ["张伟@例子.中国", "ใจดี@ตัวอย่าง.ไทย", "ಅನ@ಉದಾ.in", "_@_.com", "+@-.DE", "muñoz.øre@straße.de", arabic, "٤١١١ ١١١١ ١١١١ ١١١١", "1٢3-٤5-٦٧٨9"]
    docs = spark.createDataFrame([(i, f"see {v} now") for i, v in enumerate(values)], "doc_id long, text string")
    out = {r["doc_id"]: (r["text"], r["n_entities"]) for r in pii.pseudonymise(docs).collect()}
    for i, v in enumerate(values):
        assert out[i][1] == 1 and v not in out[i][0], v
        if "_" not in v and not v.startswith("+@"):
            assert len(out[i][0]) == len(f"see {v} now")
    assert all(c.isascii() == d.isascii() for c, d in zip(arabic, out[6][0][4:]))
    assert pii.canonical("phone", arabic) == pii.canonical("phone", "+44 20 7946 0958")


def test_names_stay_the_same_person(spark, monkeypatch):
    """Given name and surname have one surrogate each, in the full name and alone, whatever else is drawn again."""
    text = "John Miller met Mr Miller and Anna Miller; John Smith saw Mrs Smith."
    a = pii.replaced(text, {})[0].replace(";", "").rstrip(".").split(" ")
    given, family = a[0], a[1]
    assert a[4] == family and a[7] == family and a[8] == given and a[9] == a[12] != family and a[6] != "Anna"
    docs = spark.createDataFrame([(1, text), (2, " ".join(a) + ".")], "doc_id long, text string")
    first = pii.pseudonymise(docs).where("doc_id = 1").first()["text"]
    assert first == pii.replaced(text, {})[0]


def test_cycles_are_one_to_one_and_move_everything():
    for size in (2, 3, 10, 97, 1000):
        images = [pii.next_on_cycle("k", "l", size, v) for v in range(size)]
        assert sorted(images) == list(range(size)) and all(a != b for a, b in enumerate(images))


def test_surrogates_over_the_table(spark, sf_dir, odd_docs, no_docs, monkeypatch):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = {p for t in docs.values() for a, b, k in pii.entities(t) for p in pii.parts_of(k, pii.canonical(k, t[a:b]))}
    for r in pii.op4_pii_surrogates(spark, sf_dir).collect():
        assert r["text"] == pii.replaced(docs[r["doc_id"]], {})[0]
        assert not any(docs[r["doc_id"]][a:b] in r["text"] for a, b, _ in pii.entities(docs[r["doc_id"]]))
    assert len({(k, pii.replacement(k, e)) for k, e in found}) == len(found)
    assert [r["n_entities"] for r in pii.pseudonymise(odd_docs).collect()] == [0] * odd_docs.count()
    assert pii.pseudonymise(no_docs).count() == 0


def test_collisions_draw_again(spark, monkeypatch):
    first = pii.replacement("ip", "10.0.0.1")
    docs = spark.createDataFrame([(1, "see 10.0.0.1"), (2, f"see {first}"), (None, "see 10.0.0.1")], "doc_id long, text string")
    again = {(r["entity"], r["attempt"]) for r in pii.drawn_again(pii.mentioned(docs)).collect()}
    assert again == {("10.0.0.1", 1)}
    small = sorted(map(str, pii.pseudonymise(docs).collect()))
    monkeypatch.setattr(pii, "MAX_SENT", 0)
    assert sorted(map(str, pii.pseudonymise(docs).collect())) == small
    assert str(first) not in small[0] and len({x.split("see ")[1].split("'")[0] for x in small}) == 2
