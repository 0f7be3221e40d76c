import hashlib
import random
import re

from pyspark.sql import functions as F

from revlens.llm import private_terms, queries
from tests.llm.helpers import MIDDLE, SCHEMA, no_docs, odd_docs, pandas

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and sum(
            sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(digits[::-1])) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def base(text):
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, text or "") if passes(k, m[0]))


def frame(spark, texts):
    return spark.createDataFrame([(i, t, *[None] * 6) for i, t in enumerate(texts)], SCHEMA)


def found(df):
    return {r.doc_id: (r.base, r.terms) for r in private_terms.find(df).select(
        "doc_id", private_terms.joined(F.col("base")).alias("base"), private_terms.joined(F.col("terms")).alias("terms")).collect()}


def test_table_against_plain_patterns(spark):
    docs = pandas("documents", MIDDLE)
    want = {k: base(t) for k, t in zip(docs.doc_id, docs.text)}
    got = queries.op7_private_terms(spark, MIDDLE).collect()
    assert {r.doc_id: r.base_sha256 for r in got} == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}
    for r in got:
        kinds = [s.split(":")[0] for s in want[r.doc_id].split(",")]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [kinds.count(k) for k in private_terms.KINDS]
        assert r.spans.startswith(want[r.doc_id])


def test_random_strings_against_plain_patterns(spark):
    rng = random.Random(11)
    texts = ["".join(rng.choices("a.@-_%+01259é ()☃\n", k=rng.randint(0, 60))) for _ in range(1500)]
    texts += ["a@b.c_d@e.f", "a@b@c.d", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.00.1.1", "4111-1111 1111 1111",
              "+1(((((((2", "+12 345 678 90 ", "0" * 30_000, "a" * 30_000 + "@", "1 " * 20_000, "+" * 5000 + "123456789"]
    got = found(frame(spark, texts))
    for i, t in enumerate(texts):
        assert got[i][0] == base(t), t[:80]


def test_terms_that_disclose_a_value(spark):
    rng = random.Random(4)
    filler = lambda: " ".join("".join(rng.choices("bcdfg", k=5)) for _ in range(8))
    texts = [f"{filler()} zorbaland ann@x.org common {filler()}" for _ in range(5)]
    texts += [f"{filler()} common word {filler()}" for _ in range(60)] + [f"the Zorbaland, {filler()}"]
    texts += ["copies zzzzyx bob@x.org"] * 9                 # one distinct text: no support
    got = found(frame(spark, texts))
    for i, t in enumerate(texts):
        at = t.lower().find("zorbaland")
        assert got[i][1] == (f"term:{at}:{at + 9}" if at >= 0 else ""), t
        assert got[i][0] == base(t)
    clean = {r.doc_id: r.text for r in private_terms.sanitise(frame(spark, texts)).collect()}
    assert "ann@x.org" not in clean[0] and "zorbaland" not in clean[0] and "[EMAIL] common" in clean[0]
    assert clean[65].startswith("the , ") and clean[10] == texts[10]


def test_sanitise_masks_and_keeps_columns(spark):
    docs = odd_docs(spark)
    out = private_terms.sanitise(docs)
    assert out.columns == docs.columns
    by = {r.doc_id: r for r in out.collect()}
    assert by[8].text == "mail [EMAIL] or [IP], card [CARD], [PHONE]" and by[8].kept == "x"
    assert by[3].text is None and by[2].text == "" and out.count() == 13
    assert private_terms.sanitise(no_docs(spark)).collect() == []


def test_no_python_on_the_main_path(spark):
    plan = private_terms.find(odd_docs(spark))._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan and "ArrowEvalPython" not in plan


def test_terms_at_a_texts_own_ends_are_candidates(spark):
    rng = random.Random(5)
    filler = lambda: " ".join("".join(rng.choices("bcdfg", k=5)) for _ in range(12))
    texts = [f"Zorbaland ann@x.org {filler()}" for _ in range(5)] + [f"{filler()} write to bob@x.org Querbach" for _ in range(5)]
    texts += [filler() for _ in range(60)]
    got = found(frame(spark, texts))
    assert all(got[i][1] == "term:0:9" for i in range(5))
    assert all(got[i][1].endswith(f"term:{len(texts[i]) - 8}:{len(texts[i])}") for i in range(5, 10))


def test_terms_far_from_the_value_and_of_all_forms_are_candidates(spark):
    rng = random.Random(6)
    filler = lambda: " ".join("".join(rng.choices("bcdfgh", k=6)) for _ in range(20))
    names = ["Zorbaland", "Li", "王小明", "Anne-Marie", "O'Neill", "“Quux”", "[Brak]", "ID-4711x"]
    texts = [f"{' '.join(names)}. {filler()} {filler()} ann@x.org {filler()}" for _ in range(5)]
    texts += [filler() for _ in range(60)] + ["Anne alone, Neill alone"]
    got = found(frame(spark, texts))
    want, at = [], 0
    for name in names:
        bare = name.strip("“”[]")
        want.append(f"term:{at + name.index(bare)}:{at + name.index(bare) + len(bare)}")
        at += len(name) + 1
    assert all(got[i][1] == ",".join(want) for i in range(5)) and got[65][1] == ""


def test_phone_of_single_digits_is_found(spark):
    text = "call +1(2)3(4)5(6)7(8)9 now"
    assert found(frame(spark, [text]))[0][0] == base(text) == "phone:5:23"


def test_texts_of_a_term_are_counted_exactly(spark):
    plan = lambda df: df._jdf.queryExecution().toString()
    rows = private_terms.with_base(frame(spark, ["zorbaland ann@x.org"]))
    assert "approx_count_distinct" not in plan(private_terms.disclosing_terms(rows))


def test_terms_whose_lower_case_is_longer_are_found(spark):
    rng = random.Random(7)
    filler = lambda: " ".join("".join(rng.choices("bcdfg", k=6)) for _ in range(12))
    names = ["İzmirli", "Straße", "ΟΔΟΣ", "QUERBACH"]
    texts = [f"{' '.join(names)} ann@x.org {filler()}" for _ in range(5)] + [filler() for _ in range(60)]
    texts += ["before İİ ΟΔΟΣ, querbach. οδος"]
    got = found(frame(spark, texts))
    want = ",".join(f"term:{m.start()}:{m.end()}" for m in re.finditer(r"\w+", " ".join(names)))
    assert all(got[i][1] == want for i in range(5))
    assert got[65][1] == "term:10:14,term:16:24,term:26:30"
    clean = {r.doc_id: r.text for r in private_terms.sanitise(frame(spark, texts)).collect()}
    assert clean[0].strip() == f"[EMAIL] {texts[0].split('ann@x.org ')[1]}" and clean[65] == "before İİ , . "


def test_many_values_in_one_text(spark):
    """A text of 40,000 addresses, spans beside and across block borders, and overlapping kinds."""
    text = " ".join(f"u{i}@x.org ☃" for i in range(40_000))
    odd = ["".join(rng.choices(["+1 234 567 890 ", "4111 1111 1111 1111", "10.0.0.1", " ", "é☃", "a@b.c"], k=rng.randint(0, 400)))
           for rng in map(random.Random, range(40))]
    got = {r.doc_id: r for r in private_terms.with_base(frame(spark, [text, *odd])).select(
        "doc_id", private_terms.joined(F.col("base")).alias("spans"),
        private_terms.masked(F.col("text"), F.col("base")).alias("masked"),
        private_terms.masked(F.col("text"), F.col("base"), blank=True).alias("blank")).collect()}
    assert got[0].masked == " ".join(["[EMAIL] ☃"] * 40_000) and got[0].spans == base(text)
    for i, t in enumerate(odd, 1):
        assert got[i].spans == base(t)
        spans = sorted((int(a), int(b), k) for k, a, b in (x.split(":") for x in base(t).split(",") if x))
        out, blank, at = [], list(t), 0
        for a, b, kind in spans:
            blank[a:b] = " " * (b - a)
            if b > at:
                out += [t[at:max(a, at)], f"[{kind.upper()}]" if a >= at else ""]
                at = b
        assert got[i].masked == "".join(out) + t[at:] and got[i].blank == "".join(blank)
