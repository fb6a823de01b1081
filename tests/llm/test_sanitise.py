import hashlib
import re

from conftest_llm import ODD_TEXTS
from pyspark.sql import functions as F

from wareloom.llm import sanitise as S

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (2 if i % 2 else 1)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def brute(text):
    text = text or ""
    spans = [
        (m.start(), rank, m.end(), kind)
        for rank, (kind, p) in enumerate(PATTERNS.items())
        for m in re.finditer(p, text)
        if valid(kind, m[0])
    ]
    return sorted(spans)


TEXTS = [
    *ODD_TEXTS,
    "mail jo.doe@mail.example.com, or a@b, or x@y.z@w.v and é@b.co",
    "host 10.0.0.255 not 10.0.0.256, 0000255.1.2.3 and 1.2.3.4.5.6.7.8, 99999999999999999999.1.1.1",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112 or 4111111111111111x 1 2",
    "call +1 (499) 555-6503 now, +12345678, +1234567890123456, +4 (1",
    "😀 ünï +49 30 1234567 a@b.cd 4111111111111111",
    "+4111 1111 1111 1111 overlaps",
    "9" * 20_000 + " " + "1.1" * 5000,
    ("user" * 30 + " ") * 50 + "@" + "a.b" * 300,
    " ".join(f"u{i}@h{i}.org" for i in range(300)),
]


def test_base_spans_match_brute_force(frame):
    rows = S.find_spans(frame(TEXTS, extra=("spans", "_spans", "terms"))).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        spans = brute(TEXTS[r.doc_id])
        text = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        assert r.spans == text and r.n_term == 0
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        counts = [sum(s[3] == kind for s in spans) for kind in PATTERNS]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts


def leaking_corpus():
    leaks = [f"Note {w}: ask Zorblax for bob@leak.example.org today, the {w} file" for w in "alpha beta gamma delta eps zeta".split()]
    plain = [f"the {w} file is ready today and nobody should ask for it, note {i}" for i, w in enumerate(["alpha", "beta", "other"] * 30)]
    return [*leaks, *leaks[:1] * 5, *plain, "ZORBLAX alone speaks of zorblaxes"]


def test_terms_that_reveal_an_entity_are_found_wherever_they_stand(frame):
    texts = leaking_corpus()
    rows = {r.doc_id: r for r in S.find_spans(frame(texts)).collect()}
    for i, text in enumerate(texts):
        terms = [(m.start(), m.end()) for m in re.finditer(r"(?i)\bzorblax\b", text)]
        got = [tuple(map(int, s.split(":")[1:])) for s in rows[i].spans.split(",") if s.startswith("term")]
        assert got == terms and rows[i].n_term == len(terms)
        assert rows[i].n_email == text.count("@")


def test_copies_are_no_evidence(frame):
    texts = ["ask Zorblax for bob@leak.example.org today"] * 50 + [f"the text {i} is plain" for i in range(50)]
    assert sum(r.n_term for r in S.find_spans(frame(texts)).collect()) == 0


def test_texts_are_masked(frame):
    texts = [*leaking_corpus(), None, "+4111 1111 1111 1111 overlaps", "x 1.2.3.4 y"]
    docs = frame(texts, extra=("_spans", "_key"))
    out = S.sanitise(docs)
    assert out.columns == docs.columns
    clean = {r.doc_id: r.text for r in out.collect()}
    assert clean[0] == "Note alpha: ask [TERM] for [EMAIL] today, the alpha file"
    assert clean[len(texts) - 3] is None
    assert clean[len(texts) - 2] == "[PHONE] overlaps" or "4111" not in clean[len(texts) - 2]
    assert clean[len(texts) - 1] == "x [IP] y"
    for i, text in clean.items():
        assert not brute(text), (i, text)
        if not brute(texts[i]) and "zorblax" not in (texts[i] or "").lower():
            assert text == texts[i]


def test_disclosure_between_the_thresholds_generalises(frame):
    near = [f"ask Quorl for al@leak.example.org on day {i} please" for i in range(8)]
    elsewhere = [f"quorl went out on day {i}" for i in range(4)]
    plain = [f"please ask for the plain text of day number {i}" for i in range(300)]
    clean = [r.text for r in S.sanitise(frame([*near, *elsewhere, *plain])).orderBy("doc_id").collect()]
    assert clean[0] == "ask [TERM] for [EMAIL] on day 0 please" and clean[8] == "[TERM] went out on day 0"
    assert clean[12:] == plain


def test_terms_that_stand_with_the_entity_alone_are_removed(frame):
    near = [f"ask Quorl for al@leak.example.org on day {i} please" for i in range(8)]
    plain = [f"please ask for the plain text of day number {i}" for i in range(300)]
    clean = [r.text for r in S.sanitise(frame([*near, *plain])).orderBy("doc_id").collect()]
    assert clean[0] == "ask  for [EMAIL] on day 0 please" and clean[8:] == plain


def test_terms_far_from_a_rare_entity_are_found(frame):
    filler = "please ask for the plain text of day number one and the file that nobody read so far, thank you"
    far = [f"Quorl speaks on day {i}. {filler} {filler} al@leak.example.org" for i in range(4)]
    once = [f"Vexlor speaks. {filler} {filler} one@single.example.org"]
    plain = [f"{filler} speaks {i}" for i in range(300)]
    clean = [r.text for r in S.sanitise(frame([*far, *once, *plain])).orderBy("doc_id").collect()]
    assert clean[0] == f" speaks on day 0. {filler} {filler} [EMAIL]" and clean[4] == f" speaks. {filler} {filler} [EMAIL]"
    assert clean[5:] == plain


def test_a_text_of_many_spans(frame):
    """20,000 addresses in one text, found and masked in one go."""
    text = " ".join(f"ü{i} u{i}@h{i}.org" for i in range(20_000))
    docs = frame([text, "plain"])
    row = S.find_spans(docs).where("doc_id = 0").first()
    assert row.n_email == 20_000
    assert row.spans.split(",")[:20_000:4999] == [f"email:{m.start()}:{m.end()}" for m in list(re.finditer(PATTERNS["email"], text))[::4999]]
    clean = S.sanitise(docs).where("doc_id = 0").first().text
    assert clean.count("[EMAIL]") == 20_000 and "@" not in clean


def test_scans_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 3)
    rows = spark.createDataFrame([([],), ([4],), ([1, 2, 3],), (list(range(20)),)], "v array<bigint>")
    zero = F.lit(0).cast("bigint")
    out = rows.select("v", S.scan(F.col("v"), zero, S.add).alias("sums"), S.scan(F.col("v"), zero, lambda x, y: F.greatest(x, y)).alias("most")).collect()
    for r in out:
        assert r.sums == [sum(r.v[:i]) for i in range(len(r.v))]
        assert r.most == [max([0, *r.v[:i]]) for i in range(len(r.v))]


def test_terms_that_touch_base_spans_are_left_out(spark):
    span = "array<struct<start:bigint,rank:int,end:bigint,kind:string,value:string>>"
    base = [(5, 0, 9, "email", "x"), (7, 3, 20, "phone", "x"), (30, 1, 35, "ip", "x")]
    terms = [(a, 4, b, "term", "t") for a, b in ((0, 5), (0, 6), (19, 22), (20, 25), (28, 31), (36, 40), (33, 34))]
    row = spark.createDataFrame([(base, terms)], f"base {span}, terms {span}").select(S.with_terms(F.col("base"), F.col("terms")).alias("s")).first()
    free = [t for t in terms if not any(t[0] < b[2] and b[0] < t[2] for b in base)]
    assert [tuple(x) for x in row.s] == sorted([*base, *free])


def test_terms_that_mostly_stand_without_the_entity_stay(frame):
    """The share decides, not the size of the corpus: one of two texts never reveals, three of four do."""
    near = [f"zorblax says {w}@leak.example.org" for w in ("al",)] + ["zorblax went home"]
    four = [f"vexlor {w} bo@leak.example.org" for w in ("one", "two", "three")] + ["vexlor left"]
    for size in (300, 3000):
        plain = [f"says went home left plain {i} text" for i in range(size)]
        texts = [*near, *four, *plain]
        rows = S.find_spans(frame(texts)).orderBy("doc_id").collect()
        assert rows[1].n_term == 0 and all(r.n_term == 0 for r in rows[6:])


def test_no_documents(frame):
    assert S.find_spans(frame([])).count() == 0 and S.sanitise(frame([])).count() == 0
