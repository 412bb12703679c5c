from __future__ import annotations

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.llm import catalog, pii

# the base rules as they are stated
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    odd, even = d[-1::-2], d[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(x), 10)) for x in even)) % 10 == 0


def stated(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]
    return out


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab.@-+_1405 ()é%\n", max_size=60))
def test_base_spans_follow_the_rules(text):
    assert pii.base_spans(text) == stated(text)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from(["a.b@c.de", "x@y", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+12 3", "é", " ", "", ".", "@", "1"]), max_size=8))
def test_base_spans_of_joined_pieces(parts):
    text = "".join(parts)
    assert pii.base_spans(text) == stated(text)


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "+1" + " " * 300_000, "1." * 100_000, "a@" * 100_000, "a" * 100_000 + "@"):
        pii.base_spans(text)


def test_digest_columns(spark, sf_small):
    rows = {r.doc_id: r for r in catalog.op2_pii(spark, sf_small).collect()}
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for d in docs:
        want = stated(d.text or "")
        text = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in want)
        r = rows[d.doc_id]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[0] == k for x in want) for k in range(4)]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.spans.startswith(text) and [x for x in r.spans.split(",") if x and not x.startswith("term:")] == [x for x in text.split(",") if x]


def corpus():
    rnd = random.Random(2)
    word = lambda: f"w{rnd.randrange(400)}"
    fill = lambda n: " ".join(word() for _ in range(n))
    rows = [(i, f"{fill(20)} the clerk {fill(3)}") for i in range(60)]
    # "Falcon" is written beside one address only, in different contexts; "clerk" everywhere
    rows += [(100 + i, f"{fill(5 + i)} the clerk Falcon a@b.org {fill(9)}") for i in range(6)]
    # copies of one passage are one context
    rows += [(200 + i, "zebra quagga c@d.org okapi") for i in range(9)]
    return rows


def test_terms_that_give_an_entity_away(spark, docs_of):
    found = {r.doc_id: r for r in pii.find(docs_of(corpus())).collect()}
    texts = dict(corpus())
    for i in range(6):
        r, t = found[100 + i], texts[100 + i]
        assert "Falcon" in [t[x.start : x.end] for x in r.terms]
        assert not {"clerk", "the"} & {t[x.start : x.end] for x in r.terms}
    assert all(not found[i].terms for i in texts if i < 100 or i >= 200)
    clean = {r.doc_id: r.text for r in pii.sanitise(docs_of(corpus())).collect()}
    assert "Falcon" not in clean[100] and "clerk  <EMAIL> " in clean[100]
    assert clean[0] == texts[0] and clean[200] == "zebra quagga <EMAIL> okapi"


def test_rare_entities_count_too(spark, docs_of):
    rows = [(1000 + i, f"some words w{i} of the text number {i}") for i in range(600)]
    # every address in one document; a name beside three of them
    rows += [(300 + i, f"text {i} by Falcon x{i}@b.org in the end") for i in range(3)]
    # an address in two texts, a name beside it in both, in the same context
    rows += [(400 + i, f"filler{i} " * 9 + "the text of Heron y@b.org in the end of the text") for i in range(2)]
    # copies of a text are one text
    rows += [(500 + i, "zebra z@b.org") for i in range(4)]
    texts = dict(rows)
    got = {r.doc_id: {texts[r.doc_id][x.start : x.end] for x in r.terms} for r in pii.find(docs_of(rows)).collect()}
    assert all("Falcon" in got[300 + i] for i in range(3)) and all("Heron" in got[400 + i] for i in range(2))
    assert not any("the" in x or "text" in x for x in got.values())
    assert all(not got[i] for i in texts if i >= 500)


def test_disclosure_is_the_stated_share(spark, docs_of):
    import math

    rows = corpus()
    scanned = pii.scan(docs_of(rows))
    got = {r.entity: r.disclosure for r in pii.disclosures(docs_of(rows), scanned, generalise=-9.0).collect() if r.term == pii._term_hash([b"clerk"])[0]}
    total, both, with_term, with_entity = len(rows), 6, 66, 6
    want = math.log2(total * both / (with_term * with_entity)) / -math.log2(with_entity / total)
    assert got["email:a@b.org"] == pytest.approx(want)


def test_edge_cases(spark, docs_of):
    rows = [(1, None), (2, ""), (3, "x" * 50_000 + " a@b.co"), (None, "a@b.co"), (3, "other"), (4, "a@b.co"), (4, "a@b.co")]
    got = sorted((r.doc_id or 0, [(x.kind, x.start, x.end) for x in r.spans]) for r in pii.find(docs_of(rows)).collect())
    assert got == [(0, [(0, 0, 6)]), (1, []), (2, []), (3, []), (3, [(0, 50_001, 50_007)]), (4, [(0, 0, 6)]), (4, [(0, 0, 6)])]
    clean = pii.sanitise(docs_of(rows))
    assert clean.columns == docs_of(rows).columns
    assert sorted(str(r.text)[-9:] for r in clean.collect()) == sorted(["None", "", "x <EMAIL>", "<EMAIL>", "other", "<EMAIL>", "<EMAIL>"])
    assert pii.find(docs_of([])).count() == 0


def test_sanitise_keeps_columns_named_like_its_own(spark, docs_of):
    own = ["terms", "_id", "_key", "text_key", "spans", "near", "row", "places"]
    docs = docs_of(corpus())
    named = docs.select("*", *[F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")).alias(c) for c in own])
    got = {r.doc_id: r for r in pii.sanitise(named).collect()}
    want = {r.doc_id: r.text for r in pii.sanitise(docs).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r[c] == f"{c} of {i}" for i, r in got.items() for c in own) and pii.sanitise(named).columns == named.columns


def test_redact_overlaps_and_generalises():
    text = "call +1 4111 1111 1111 1111 now 12 Bob"
    out = pii.redact(text, [(2, 5, 27), (3, 7, 27)], [(32, 34, 0.85), (35, 38, 0.99)])
    assert out == "call <CARD> now <number> "


def lowered(word):
    return "".join(c.lower() if "A" <= c <= "Z" or "À" <= c <= "Þ" and c != "×" else c for c in word)


def revealed(rows, window, support, generalise):
    """doc_id -> (start, end, disclosure) of revealing terms, straight from the definitions; ids are unique."""
    import math
    from collections import defaultdict

    word = re.compile(r"[A-Za-z0-9\u0080-\U0010ffff]+")
    near, has, texts_of, docs_with = {}, defaultdict(set), {}, defaultdict(set)
    for i, text in rows:
        text = text or ""
        spans = stated(text)
        texts_of[i] = text
        for m in word.finditer(text):
            has[lowered(m.group())].add(i)
        near[i] = defaultdict(set)
        for k, a, b in spans:
            value = text[a:b].lower() if k < 2 else re.sub("[^0-9]", "", text[a:b])
            entity = (k, value)
            docs_with[entity].add(i)
            before = [m.span() for m in word.finditer(text[:a])][-window:]
            after = [(b + m.start(), b + m.end()) for m in word.finditer(text[b:])][:window]
            for s, e in before + after:
                if e - s > 1 and not any(s < y and x < e for _, x, y in spans):
                    near[i][entity, lowered(text[s:e])].add((s, e))
    pair_docs, kind_texts = defaultdict(set), defaultdict(set)
    for i, found in near.items():
        for entity, term in found:
            pair_docs[entity, term].add(i)
            kind_texts[entity[0], term].add(texts_of[i])
    total, out = len(rows), defaultdict(dict)
    for (entity, term), docs in pair_docs.items():
        n_e, texts_e = len(docs_with[entity]), len({texts_of[i] for i in docs_with[entity]})
        texts_te = len({texts_of[i] for i in docs})
        if n_e == total or not (len(kind_texts[entity[0], term]) >= support or texts_te >= min(support, max(2, texts_e))):
            continue
        share = math.log2(total * len(docs) / (len(has[term]) * n_e)) / -math.log2(n_e / total)
        if share >= generalise:
            for i in docs:
                for place in near[i][entity, term]:
                    out[i][place] = max(share, out[i].get(place, share))
    return {i: sorted((s, e, d) for (s, e), d in places.items()) for i, places in out.items()}


@pytest.mark.parametrize("generalise", [0.7, 0.3])  # three of so few documents tell less than 0.8
def test_terms_planted_in_the_tables_texts_equal_brute_force(spark, docs_of, sf_small, generalise):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    texts = {r.doc_id: r.text for r in docs}
    ids = sorted(i for i, t in texts.items() if t)
    add = lambda i, s: texts.__setitem__(i, texts[i] + s)
    for n, i in enumerate(ids[:3]):  # a nickname beside three addresses of one document each
        add(i, f" Said Quillfeather of desk{n}@plant.example on that day.")
    for i in ids[5:7]:  # a name in both texts of one number, an adjective in other texts too
        add(i, " The harbourmaster, Ostrava-born, answers +44 (20) 7946 0958 in the end.")
    for i in ids[8:40]:
        add(i, " Ostrava is a town.")
    add(ids[50], " Onlyonce writes from lone@plant.example now.")
    rows = list(texts.items())
    got = {r.doc_id: [(x.start, x.end, x.disclosure) for x in r.terms] for r in pii.find(docs_of(rows), generalise=generalise).collect()}
    want = revealed(rows, pii.WINDOW, pii.SUPPORT, generalise)
    assert {i: [x[:2] for x in t] for i, t in got.items() if t} == {i: [x[:2] for x in t] for i, t in want.items()}
    assert all(x[2] == pytest.approx(y[2]) for i, t in want.items() for x, y in zip(got[i], t, strict=True))
    words = {i: {texts[i][s:e] for s, e, _ in t} for i, t in got.items()}
    assert all("Quillfeather" in words[i] for i in ids[:3]) and all("harbourmaster" in words[i] for i in ids[5:7])
    assert "Onlyonce" not in words[ids[50]]
    if generalise == 0.7:
        assert not any("Ostrava" in w for w in words.values())
        clean = {r.doc_id: r.text for r in pii.sanitise(docs_of(rows), generalise=generalise).collect()}
        assert not any("Quillfeather" in t or "harbourmaster" in t for t in clean.values() if t)
        assert all(clean[i] == texts[i] for i in texts if not stated(texts[i] or "") and texts[i] is not None)
