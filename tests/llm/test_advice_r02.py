
import base64
import random
import re
import string
import time

import pytest

from portflow.llm import html_region, pii, quality_rules

SF = "/root/testdata/sf0.001"

# 5 -------------------------------------------------------------------------------------------------------------------

#: texts that hold nothing but one match: what each filter must let through
ONLY = {
    "base": (["a@b.c"], ["1.2.3.4"], ["4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "4-1-1-1-1-1-1-1-1-1-1-1-1-1-1-1", "4111111111111111"], ["+1(4)2-5 5 5 9 6 8 4"]),
    "loose": (["joe@example[dot]com", "joe@example(dot)com", "joe@example{dot}com", "joe@example .com", "joe@example. com", "joe[at]example.com", "joe(at)example.com",
               "joe{at}example.com", "joe @example.com", "joe@ example.com"],
              ["a:b:c:d:e:f:0:1"], ["4111 1111 1111 1111", "4111.1111.1111.1111", "4111-1111-1111-1111"], ["001 425 9684", "(425) 555-9684", "425.555.9684"]),
}


def test_every_filter_lets_its_own_matches_through(spark):
    for side, patterns, needs in (("base", pii.BASE, pii.NEEDS), ("loose", pii.LOOSE, pii.LOOSE_NEEDS)):
        for k, texts in enumerate(ONLY[side]):
            df = spark.createDataFrame([(t,) for t in texts], "text string")
            got = df.select("text", pii._parts(df.text, patterns[k], needs[k]).alias("parts")).collect()
            assert [(r["text"], list(r["parts"] or [])) for r in got] == [(t, ["", t, ""]) for t in texts], (side, pii.KINDS[k])


def test_parted_card_and_dot_forms_are_found(spark):
    texts = ["pay with 4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1 today", "joe@example[dot]com"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    base = {r["doc_id"]: r["n_card"] for r in pii.digest(pii.find_personal_data(df)).collect()}
    loose = {r["doc_id"]: [x["value"] for x in r["loose"]] for r in pii.candidates(df).collect()}
    assert base == {0: 1, 1: 0} and loose == {0: [], 1: ["joe@example[dot]com"]}


# 6 -------------------------------------------------------------------------------------------------------------------

BODY = "<h1>Head line</h1>" + "<p>Some words of the one text that this page is about.</p>" * 12
WANT = "\n\n".join(["Head line"] + ["Some words of the one text that this page is about."] * 12)
AROUND = '<div class="ad">buy this now please</div><nav><ul><li><a href="/a">a b c</a></li></ul></nav>{}<footer>site and many words here</footer>'


@pytest.mark.parametrize("labelled", [True, False])
@pytest.mark.parametrize("opened", ['<div class="content-sidebar-wrap">', '<div class="layout has-sidebar">', '<section id="no-comments">', '<div class="post social">', "<form>", "<header>",
                                    '<form><div class="has-sidebar">'])
def test_containers_that_hold_the_text_are_kept(opened, labelled):
    inner = f"<article>{BODY}</article>" if labelled else BODY
    page = AROUND.format(f'{opened}{inner}<div class="sidebar">other words</div>' + "".join(f"</{name}>" for name in reversed(re.findall("<([a-z]+)", opened))))
    weights = html_region.learn([AROUND.format(f"<article>{BODY}</article>")] * 5)
    assert html_region.extract(f"<html><body>{page}</body></html>", weights) == WANT


def test_asides_are_left_out():
    weights = html_region.learn([AROUND.format(f"<article>{BODY}</article>")] * 5)
    comments = '<div class="comments">' + "<article><p>me too and so on</p></article>" * 9 + "</div>"
    for page in (AROUND.format(f"<article>{BODY}{comments}</article>"), AROUND.format(f"<div>{BODY}{comments}</div>"), AROUND.format(f"<main>{BODY}<aside>not closed</main>")):
        assert html_region.extract(page, weights) == WANT
    assert html_region.extract(AROUND.format(""), weights) == ""


def test_raw_ends_are_found_on_the_page_itself():
    assert html_region.extract("<p>İİİİİİİİİ</p><script>a</scripted>b</SCRIPT>one two three four", {}) == "one two three four"


def test_deep_and_unclosed_marks_take_little_time():
    start = time.perf_counter()
    html_region.extract('<div class="ad"><p>some words here' * 20000, {})
    html_region.extract('<div class="ad"><p>some words here' * 20000 + "</p></div>" * 20000, {})
    assert time.perf_counter() - start < 20


# 1 -------------------------------------------------------------------------------------------------------------------

def junk(kind, n, r):
    one = {"letters": lambda: "".join(r.choices(string.ascii_lowercase, k=r.randint(3, 10))), "mixed": lambda: "".join(r.choices(string.ascii_letters, k=r.randint(3, 10))),
           "digits": lambda: "".join(r.choices(string.ascii_lowercase + string.digits, k=r.randint(3, 10))), "base64": lambda: base64.b64encode(r.randbytes(r.randint(6, 57))).decode(),
           "hex": lambda: r.randbytes(r.randint(2, 16)).hex()}[kind]
    return " ".join(one() for _ in range(n))


def test_junk_is_rejected_in_every_language(spark):
    r = random.Random(3)
    rows = [(junk(kind, n, r), lang, kind) for kind in ("letters", "mixed", "digits", "base64", "hex") for lang in (*quality_rules.BANDS, "xx", "", None) for n in (40, 100, 1000)]
    df = spark.createDataFrame([(k, *x) for k, x in enumerate(rows)], "doc_id long, text string, lang string, kind string")
    out = quality_rules.quality_rules(df).join(df.select("doc_id", "lang", "kind"), "doc_id")
    assert out.where("base_failed").count() == 0
    assert [(x["kind"], x["lang"], x["chars_per_token"], x["chars_per_merged"]) for x in out.where("kept").collect()] == []


def test_clean_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    for df in (docs, docs.drop("lang")):
        assert quality_rules.quality_rules(df).where("not kept and not base_failed").count() == 0
