from __future__ import annotations

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import (
    bytesets,
    catalog,
    decontamination,
    gru,
    html_text,
    linear,
    mixing,
    near_duplicates,
    pii,
    quality_rules,
    recurrent_lm,
    secrets,
    site_quality,
    toxicity,
)
from tidemark.llm.linear import LinearModel

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, key string, label int, spans string"

LONG = " ".join(f"word{i % 97}x{i}" for i in range(30_000))
EDGES = [
    (1, None, "en", "a", 0, 1, "k", 1, "s"),
    (2, "", None, None, 0, 1, "k", 1, "s"),
    (3, " \t\n\x0b ", "en", "a", 5, 1, "k", 1, "s"),
    (4, "one two", "en", "a", 7, 1, "k", 1, "s"),
    (5, "One  TWO", "en", "b", 8, 1, "k", 1, "s"),
    (6, LONG, "en", "b", len(LONG), 1, "k", 1, "s"),
    (7, LONG + " tail", "en", "b", 1, 1, "k", 1, "s"),
    (7, LONG + " tail", "en", "b", 1, 1, "k", 1, "s"),
    (None, "no id here", None, "b", 10, None, None, None, None),
]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


def texts_of(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- secrets -----------------------------------------------------------------------------

PLAIN = {
    "assign": (r"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]+", 0, 16),
}


def plain_secrets(text):
    out = []
    for n, (kind, (pattern, group, least)) in enumerate(PLAIN.items()):
        flags = re.I | re.A if kind == "assign" else 0
        out += [(m.start(), n, kind, m.end()) for m in re.finditer(pattern, text, flags) if len(m[group]) >= least]
    return sorted(out)


def test_secret_spans_match_plain_scan(spark, docs):
    extra = [
        (9001, "é token = 'abcdefghijkl' secret:: x AKIAABCDEFGHIJKLMN deadbeefdeadbeef0"),
        (9002, "token=secret: abcdefghijklmnopq password=token=abcdefghijkl"),
        (9003, None),
    ]
    df = docs.select("doc_id", "text", "source").union(
        spark.createDataFrame([(i, t, "x") for i, t in extra], "doc_id long, text string, source string")
    )
    got = by_id(secrets.secrets_digest(df))
    for i, text in texts_of(df):
        want = plain_secrets(text)
        joined = ",".join(f"{k}:{s}:{e}" for s, _, k, e in want)
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in PLAIN] == [sum(w[2] == k for w in want) for k in PLAIN]
        assert {f"{k}:{s}:{e}" for s, _, k, e in want} <= set(got[i]["spans"].split(","))or not want


def test_widely_copied_values_are_examples(spark):
    shared, own = "token = 0123456789abcdefghij", "token = zyxw9876vutsrqpo"
    rows = [(i, shared, f"s{i}") for i in range(5)] + [(9, own, "s1")]
    got = by_id(secrets.secrets_digest(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    assert got[0]["n_example"] >= 1 and got[0]["n_live"] == 0
    assert got[9]["n_live"] == 1 and got[9]["n_example"] == 0


def test_values_in_many_repositories_of_one_owner_are_examples(spark):
    copied, own = "see qwertyUIOP0123456789zx here", "token = zyxw9876vutsrqpo"
    rows = [(i, copied, "hot") for i in range(40)] + [(50 + i, own, "hot") for i in range(3)] + [(90, copied, "hot")] * 2
    got = by_id(secrets.secrets_digest(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    assert got[0]["n_live"] == 0 and got[0]["spans"] == ""
    assert got[51]["n_live"] == 1 and got[51]["n_example"] == 0
    twice = secrets.secrets_digest(spark.createDataFrame([(1, copied, "hot")] * 40, "doc_id long, text string, source string"))
    assert twice.first()["n_live"] == 1


# --- mixing ------------------------------------------------------------------------------


def test_mix_agrees_with_sql(spark, docs):
    got = {tuple(r) for r in mixing.mix_sources(docs).collect()}
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert got == set(db.execute(mixing.MIX_SQL).fetchall())


def test_mix_with_carried_columns_agrees(spark, docs):
    plain = Counter(tuple(r) for r in mixing.mix_sources(docs).collect())
    carried = mixing.mix_sources(docs, carry=("text", "source", "lang"))
    names = ["doc_id", "size", "source_size", "target", "taken"]
    assert Counter(tuple(r) for r in carried.select(*names).collect()) == plain
    given = {r["doc_id"]: (r["text"], r["source"], r["lang"]) for r in docs.collect()}
    assert all(given[r["doc_id"]] == (r["text"], r["source"], r["lang"]) for r in carried.collect())


def test_mix_with_carried_columns_of_edges_and_copies(spark, edges):
    copies = [(7, f"same words {i % 3}", "en", "b", i, i, "k", 1, "s") for i in range(40)]
    rows = edges.union(spark.createDataFrame(copies + [(8, "x y z", "en", None, 1, 1, "k", 1, "s")] * 9, SCHEMA))
    rows = rows.where("doc_id is null or doc_id not in (6)")
    names = ["doc_id", "size", "source_size", "target", "taken"]
    plain = Counter(tuple(r) for r in mixing.mix_sources(rows).collect())
    carried = mixing.mix_sources(rows, carry=("text", "row", "key", "label", "spans"))
    assert Counter(tuple(r) for r in carried.select(*names).collect()) == plain
    assert len({(r["size"], r["taken"]) for r in carried.where("doc_id = 7").collect()}) > 1
    assert mixing.mix_sources(rows.limit(0), carry=("text",)).count() == 0


def test_mix_limits_and_edges(edges):
    rows = mixing.mix_sources(edges).collect()
    assert len(rows) == len(EDGES)
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    assert all(r["target"] <= 2 * r["source_size"] for r in rows)


# --- near duplicates -----------------------------------------------------------------------


def plain_components(texts, width):
    sets = {}
    for n, (i, text) in enumerate(texts):
        w = text.encode().lower().split()
        sets[n] = (i, {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    parent = {i: i for i, _ in sets.values()}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    owners = defaultdict(list)
    for n, (_, s) in sets.items():
        for x in s:
            owners[x].append(n)
    overlap = Counter(p for o in owners.values() for p in combinations(o, 2))
    for (a, b), n in overlap.items():
        if 100 * n >= 80 * (len(sets[a][1]) + len(sets[b][1]) - n):
            x, y = sorted((root(sets[a][0]), root(sets[b][0])))
            parent[y] = x
    return {(i, len(s)): root(i) for i, s in sets.values()}


@pytest.mark.parametrize("small, block", [(64, 512), (1, 3)])
def test_components_match_all_pairs(spark, docs, monkeypatch, small, block):
    monkeypatch.setattr(near_duplicates, "SMALL_BUCKET", small)
    monkeypatch.setattr(near_duplicates, "BLOCK", block)
    base = [f"w{i}" for i in range(60)]
    near = [(5000 + k, " ".join(base[:k] + [f"new{k}"] + base[k + 1 :]), "x") for k in range(0, 60, 4)]
    heavy = [(6000 + k, " ".join(w if i % 9 != k else f"h{k}" for i, w in enumerate(base)), "x") for k in range(9)]
    df = docs.select("doc_id", "text", "source").union(
        spark.createDataFrame(near + heavy, "doc_id long, text string, source string")
    )
    want = plain_components(texts_of(df), 4)
    got = near_duplicates.near_duplicates(df, 4).collect()
    assert {(r["doc_id"], r["n_shingles"]): r["component_id"] for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicate_edges(edges):
    got = near_duplicates.near_duplicates(edges, 4).collect()
    assert len(got) == len(EDGES)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in got}
    assert found[1] == (0, 1, True) and found[3] == (0, 3, True)
    assert found[4] == (1, 4, True) and found[5] == (1, 4, False)
    assert found[7][1] == 6 and found[None][1:] == (None, True)
    kept = near_duplicates.keep_one_of_each(edges, 4)
    assert kept.columns == edges.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "3", "4", "6", "None"]


def test_empty_tables(spark, labels):
    none = spark.createDataFrame([], SCHEMA)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert near_duplicates.near_duplicates(none).count() == 0
    assert secrets.secrets_digest(none).count() == 0
    assert mixing.mix_sources(none).count() == 0
    assert decontamination.find_leaks(none, bench).count() == 0
    assert pii.personal_data_digest(none).count() == 0
    assert site_quality.site_quality(none, labels).count() == 0
    assert toxicity.toxicity_digest(none, labels).count() == 0
    assert recurrent_lm.score_documents(none).count() == 0
    model = quality_rules.fit_quality(none, labels)
    assert quality_rules.judge_quality(none, model).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert html_text.extract_main_text(pages).count() == 0


# --- quality -------------------------------------------------------------------------------


def plain_counts(text):
    white = "\x20\t\n\x0b\x0c\r"
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if line.strip(white):
            dup += line in seen
            seen.add(line)
    three = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    times = Counter(three)
    covered = {k + j for k, t in enumerate(three) if times[t] > 1 for j in range(3)}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)]


def test_quality_counts(docs, edges, labels):
    model = quality_rules.fit_quality(docs, labels)
    for df in (docs, edges):
        got = quality_rules.judge_quality(df, model).collect()
        want = defaultdict(list)
        for i, text in texts_of(df):
            want[i].append(plain_counts(text))
        for r in got:
            c = [r[k] for k in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
            assert c in want[r["doc_id"]]
            assert r["base_failed"] == (c[0] < 50 or 100 * c[4] > 50 * c[0])
            assert not (r["base_failed"] and r["kept"])


def test_repeated_ids_count_once_in_the_fit(spark, docs, labels):
    once = quality_rules.fit_quality(docs, labels, 40)
    twice = quality_rules.fit_quality(docs.union(docs).repartition(5), labels, 40)
    assert np.array_equal(once.weights, twice.weights) and once.bias == twice.bias


def test_learned_quality_separates_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, marks = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality_rules.fit_quality(docs, marks, max_rows=250)
    got = by_id(quality_rules.judge_quality(docs, model))
    good = [got[r["doc_id"]]["quality"] >= 0.5 for r in marks.collect() if r["quality"] == 1]
    bad = [got[r["doc_id"]]["quality"] >= 0.5 for r in marks.collect() if r["quality"] == 0]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.4


def test_site_quality_shrinks_sparse_sites(spark, docs, labels, edges):
    rows = site_quality.site_quality(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert site_quality.site_quality(edges, labels).count() == len(EDGES)


# --- personal data ---------------------------------------------------------------------------


def plain_pii(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 16 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_personal_data(spark, docs):
    extra = [
        (9001, "é a@b.c@d.e @x.y z@q 1.2.3.4.5.6.7.8 300.1.1.1 4111 1111-1111 1111 +1 (2) 345-67890"),
        (9002, "IBAN GB82 WEST 1234 5698 7654 32 ssn 123-45-6789"),
        (9003, None),
        (9004, "at 1.2.3." + "0" * 5001 + " and " + "0" * 5000 + "7.1.1.1 and 1.2.3." + "9" * 5001),
    ]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(extra, "doc_id long, text string"))
    got = by_id(pii.personal_data_digest(df))
    for i, text in texts_of(df):
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in plain_pii(text))
        assert got[i]["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
    assert "iban:" in got[9002]["spans"] and "ssn:" in got[9002]["spans"]
    masked = by_id(pii.mask_personal_data(df))
    assert "<email>" in masked[9001]["text"] and masked[9003]["text"] is None


# --- pages -------------------------------------------------------------------------------------


def test_site_templates_and_structure(spark):
    def page(k):
        return (
            k, "http://www.x.example/p",
            "<html><head><title>t</title><script>var a='</p>';</script></head><body><nav><a>menu</a></nav>"
            f"<div><p>Follow our channel</p></div><h1>Title {k}</h1><p><b>First&amp;  best<br>line {k}</p><p>Second {k}"
            "<div class='comments'><p>nice!</p></div><footer>foot</footer></body></html>",
        )

    rows = [page(k) for k in range(6)] + [(90, None, None), (91, "x", ""), (92, "http://x.example/q", "<p>plain &lt;b")]
    got = {r["page_id"]: r["text"] for r in html_text.extract_main_text(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Title 3\nFirst& best line 3\nSecond 3"
    assert got[90] == got[91] == "" and got[92] == "plain <b"


def test_article_is_kept_whole(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    html = {r["page_id"]: r["html"] for r in pages.collect()}
    for r in html_text.extract_main_text(pages).collect():
        body = re.search(r"<article>(.*?)</article>", html[r["page_id"]], re.S)[1]
        import html as h

        blocks = [re.sub(r"\s+", " ", h.unescape(re.sub(r"<[^>]*>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", body)]
        assert r["text"] == "\n".join(b for b in blocks if b) and r["n_chars"] == len(r["text"])


def test_page_structure_by_attributes_comments_and_mass():
    def text(page):
        return "\n".join(map(html_text.line_of, html_text.parse_blocks(page)[0]))

    # "hidden" is an attribute of its own, not a word in another one's value.
    assert text('<p title="the hidden cost">a</p><p data-note="some hidden thing">b</p><div class="x hidden y">c</div>') == "a\nb\nc"
    assert text('<article class="x hidden y">c</article>') == "c"
    assert text('<p hidden>a</p><p HIDDEN="">b</p><p aria-hidden=true>c</p><p style="color:red; display : none">d</p><p>e</p>') == "e"
    # What readers wrote goes at any depth, also where each comment is an article.
    comments = '<div class="comments-area"><article class="comment"><p>reader says</p></article></div>'
    assert text(f"{comments}<div><p>body</p></div>") == "body"
    assert text(f'<article><p>body</p><div class="comment"><p>me too</p></div>{comments}<p>end</p></article>') == "body\nend"
    assert text('<article class="comment"><p>an opinion piece</p></article>') == "an opinion piece"
    assert text('<div id="page" class="no-comments"><p>body</p></div>') == "body"
    # Teasers don't make the rest of the page furniture; links don't outweigh a short article.
    body = '<div id="content"><h1>Title</h1><p>All the main text.</p></div>'
    assert text(f'{body}<div class="more"><article><a>Teaser</a></article></div>').startswith("Title\nAll the main text.")
    links = "".join(f"<li><a href=/{k}>Another page of this site</a></li>" for k in range(50))
    assert text(f"<ul>{links}</ul><article><p>Short.</p></article>") == "Short."


def main_texts(spark, bodies, url="http://x.example/p"):
    pages = spark.createDataFrame([(k, url, b) for k, b in enumerate(bodies)], "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in html_text.extract_main_text(pages).collect()}


def test_recurring_inline_pieces_do_not_take_their_paragraph(spark):
    got = main_texts(spark, [f"<p><a>By Staff</a> unique {k}</p><p>lead {k} <b>LONDON</b>  tail {k}</p>" for k in range(6)])
    assert got[2] == "unique 2\nlead 2 tail 2"


def test_names_drop_whole_matches_and_never_the_main_part():
    def text(page):
        return "\n".join(map(html_text.line_of, html_text.parse_blocks(page)[0]))

    assert text('<article class="post has-sidebar"><h1 class="entry-header">T</h1><p class="alert">a</p></article>') == "T\na"
    assert text('<div id="page" class="no-comments"><p>one</p><span class="ad">buy</span></div>') == "one"
    assert text('<form><div class="modal"><article><p>kept</p><div class="comments">c</div></article></div></form>') == "kept"
    assert text('<div class="sidebar">s</div><div role="search">q</div><p>x <i class="ads">ad</i> y') == "x y"
    assert text("<header><p>top</p></header><nav><h1>n</h1></nav><p>z") == "z"


def test_rotating_pieces_go_outside_a_marked_main_part_only(spark):
    def body(k):
        advert = f"<div><p>Buy lamp {k % 6}</p></div>" if k % 2 else ""
        return f"<p>unique {k}</p>{advert}"

    got = main_texts(spark, [body(k) for k in range(60)] + [f"<p>Said twice</p><p>alone {k}</p>" for k in range(3)])
    assert all(got[k] == f"unique {k}" for k in range(60)) and got[61] == "Said twice\nalone 1"
    got = main_texts(spark, [f"<article>{body(k)}</article>" for k in range(60)])
    assert got[3] == "unique 3\nBuy lamp 3" and got[4] == "unique 4"


# --- toxicity ----------------------------------------------------------------------------------


def test_block_max_search_is_exact():
    rng = np.random.default_rng(1)
    vectors = []
    for _ in range(700):
        t = np.sort(rng.choice(40, rng.integers(1, 6), replace=False))
        w = rng.random(len(t)) + 0.1
        vectors.append((t, w / np.sqrt((w * w).sum())))
    index = toxicity.BlockMaxIndex(np.arange(700), rng.integers(0, 2, 700), vectors, 40)
    dense = np.zeros((700, 40))
    for i, (t, w) in enumerate(vectors):
        dense[i, t] = w
    for _ in range(50):
        t = np.sort(rng.choice(40, 4, replace=False))
        q = rng.random(4) + 0.1
        best, cosine = index.nearest(t, q, 10)
        full = dense[:, t] @ q
        assert np.allclose(np.sort(cosine)[::-1], np.sort(full)[::-1][: len(cosine)])
        assert np.allclose(full[index.ids[best]], cosine)


def test_toxicity_on_held_out_rows(spark, edges):
    folder = "/root/testdata/sf0.1"
    docs, marks = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    rows = toxicity.toxicity_digest(docs, marks).join(marks, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    hit = sum(r["predicted"] and r["toxic"] for r in rows)
    assert hit / sum(r["predicted"] for r in rows) > 0.85 and hit / sum(r["toxic"] for r in rows) > 0.8
    assert toxicity.toxicity_digest(edges, marks).count() == len(EDGES)


# --- language model -------------------------------------------------------------------------------


def test_gradient_matches_differences():
    rng = np.random.default_rng(0)
    p = gru.initial(np.full(gru.N_CLASSES, 5.0), np.ones((gru.HEAD_CLASSES, gru.MEMBERS)))
    p = {k: v.astype(np.float64) for k, v in p.items()}
    x, c, m = (rng.integers(0, n, (3, 7)) for n in (gru.N_INPUTS, gru.N_CLASSES, gru.MEMBERS))
    c[0, 5:] = -1
    h = rng.normal(0, 0.3, (3, gru.HIDDEN))
    _, grad, _ = gru.loss_and_gradient(p, h, x, c, m)
    for k in ("w_rec", "w_in", "b", "w_class", "b_class"):
        at = np.unravel_index(np.abs(grad[k]).argmax(), grad[k].shape)
        up, down = ({**p, k: p[k].copy()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        slope = (gru.loss_and_gradient(up, h, x, c, m)[0] - gru.loss_and_gradient(down, h, x, c, m)[0]) / 2e-5
        assert slope == pytest.approx(grad[k][at], rel=1e-3)


def test_language_model_scores(docs, edges):
    rows = recurrent_lm.score_documents(docs).collect()
    tokens = {i: [*t.encode().lower().split(), None] for i, t in texts_of(docs)}
    counts = Counter()
    for i, w in tokens.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            counts.update(w)
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        w = tokens[r["doc_id"]]
        base = sum(math.log10((counts.get(x, 0) + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        assert r["base_score"] == pytest.approx(base, abs=1e-6)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(w), sum(x in counts for x in w), n)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    scored = recurrent_lm.score_documents(edges).collect()
    assert len(scored) == len(EDGES) and all(r["n_tokens"] == 1 for r in scored if r["doc_id"] in (1, 2, 3))


def test_every_training_token_is_walked(spark):
    rows = [(1, "a b c"), (2, None), (3, "b a"), (4, " ".join(f"w{i % 700}" for i in range(70_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    words = recurrent_lm.Lexicon(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    shared = spark.sparkContext.broadcast(words)
    got = recurrent_lm.training_documents(docs, shared).orderBy("order", "piece").collect()
    assert [r["size"] for r in got if r["piece"] == 0] != [] and sum(r["size"] for r in got) == 4 + 1 + 3 + 70_001
    long = [np.frombuffer(r["data"], np.int16) for r in got if r["order"] in {x["order"] for x in got if x["piece"] == 1}]
    assert len(long) == 2 and long[0][0] == gru.START and long[1][0] == long[0][-1]
    assert len(set(np.concatenate([x[1:] for x in long]).tolist())) > 400
    size = np.array([len(r["data"]) // 2 - 1 for r in got])
    assert sorted(i for lane in gru.lanes(size, np.arange(len(size)), 3) for i in lane) == list(range(len(size)))


def test_texts_in_a_lane_are_apart_and_rare_cells_are_learnt():
    p = gru.initial(np.full(gru.N_CLASSES, 5.0), np.ones((gru.HEAD_CLASSES, gru.MEMBERS)))
    cell = gru.N_HEAD + 9 * gru.MEMBERS
    texts = [np.array([gru.START, 5, cell + 3, cell + 60, 7], np.int16), np.array([gru.START, 8, cell + 40, 9], np.int16)]
    flat = np.concatenate([t[1:] for t in texts]).astype(np.int64)
    inputs = np.concatenate([t[:-1] for t in texts]).astype(np.int64)
    bounds = np.array([0, 4, 7])
    value = lambda q: gru.log_likelihoods(q, inputs, flat // gru.MEMBERS, flat % gru.MEMBERS, bounds)
    h = np.zeros((1, gru.HIDDEN), np.float32)
    loss, _, _ = gru.loss_and_gradient(p, h, inputs[None], flat[None] // gru.MEMBERS, flat[None] % gru.MEMBERS)
    assert loss * 7 == pytest.approx(-value(p).sum(), rel=1e-4)
    learnt = gru.train(p, texts, 2, 1, 300, 0.05, 0)
    assert value(learnt).sum() > -0.5 * 7 > value(p).sum()


def test_packed_gradient_matches_differences_across_texts():
    rng = np.random.default_rng(3)
    p = gru.initial(rng.uniform(1, 9, gru.N_CLASSES), rng.uniform(1, 9, (gru.N_CLASSES, gru.MEMBERS)))
    p = {k: v.astype(np.float64) for k, v in p.items()}
    x, c, m = rng.integers(0, 6, (4, 9)), rng.integers(0, 5, (4, 9)), rng.integers(0, 7, (4, 9))
    x[1, 3] = x[2, 0] = x[2, 8] = gru.START  # texts begin inside the window
    c[0, 5:] = -1
    h = rng.normal(0, 0.3, (4, gru.HIDDEN))
    packed = np.full(gru.N_PARAMETERS, 7.0)
    _, grad, after = gru.loss_and_gradient(p, h, x, c, m, packed)
    assert after.shape == h.shape and np.array_equal(np.concatenate([grad[k].ravel() for k in gru.SHAPES]), packed)
    for k in gru.SHAPES:
        at = np.unravel_index(np.abs(grad[k]).argmax(), grad[k].shape)
        up, down = ({**p, k: p[k].copy()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        slope = (gru.loss_and_gradient(up, h, x, c, m)[0] - gru.loss_and_gradient(down, h, x, c, m)[0]) / 2e-5
        assert slope == pytest.approx(grad[k][at], rel=1e-3), k
    untouched = np.setdiff1d(np.arange(gru.N_INPUTS), x)
    assert not grad["embed"][untouched].any() and not grad["w_member"][5:].any()


def test_adaptive_steps_of_packed_parameters():
    rng = np.random.default_rng(4)
    n = 2 * gru._LOT + 5
    p, m, v = rng.normal(size=n), np.zeros(n), np.zeros(n)
    want, wm, wv = p.copy(), m.copy(), v.copy()
    adam = gru.Adam(0.02)
    for t in range(1, 4):
        g = rng.normal(size=n)
        adam.apply(p, g, m, v)
        wm += 0.1 * (g - wm)
        wv += 0.01 * (g * g - wv)
        want -= 0.02 * (wm / (1 - 0.9**t)) / (np.sqrt(wv / (1 - 0.99**t)) + 1e-6)
    assert np.allclose(p, want, rtol=1e-9, atol=1e-12)


# --- decontamination -------------------------------------------------------------------------------


def test_planted_passages_are_found(spark):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    items = {r["item_id"]: r["text"] for r in bench.collect()}
    passage = items[3]
    edited = passage[:40] + "X" + passage[41:90] + passage[91:]
    rows = [
        (1, "Some lead. " + passage + " And a tail."),
        (2, "lead " + edited.upper() + " tail"),
        (3, " ".join(reversed(passage.split()))),
        (4, None),
        (5, passage[: len(passage) // 5]),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in decontamination.find_leaks(df, bench).collect()}
    assert got[(1, 3)] == 0 and (2, 3) in got
    assert not {d for d, _ in got} & {3, 4, 5}
    assert sorted(r["doc_id"] for r in decontamination.drop_leaks(df, bench).collect()) == [3, 4, 5]


def test_benchmark_in_several_blocks(spark, docs, monkeypatch):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    whole = {tuple(r) for r in decontamination.find_leaks(docs, bench).collect()}
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 1000)
    assert {tuple(r) for r in decontamination.find_leaks(docs, bench).collect()} == whole
    fold = lambda t: " ".join(re.findall(r"[a-z0-9]+|[^\x00-\x7f]+", t.lower()))
    for item in bench.collect():
        for i, text in texts_of(docs):
            if fold(item["text"]) in fold(text):
                assert any((d, k) == (i, item["item_id"]) for d, k, *_ in whole)


def test_edit_distance_in_region():
    assert decontamination.edit_distance_within(b"abcdef", b"xxabcdefyy") == 0
    assert decontamination.edit_distance_within(b"abcdef", b"xxabXdefyy") == 1
    assert decontamination.edit_distance_within(b"abcdef", b"xxabdefyy") == 1


# --- all together -------------------------------------------------------------------------------------


def test_pipeline_stage_by_stage(spark, docs):
    import corpus_pipeline

    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    out, before = docs, None
    for name, stage in corpus_pipeline.STAGES:
        before, out = out, stage(spark, out, SMALL)
        if name != "mixing":
            assert out.columns == docs.columns
        rows = out.collect()
        ids = {r["doc_id"] for r in rows}
        assert ids <= {r["doc_id"] for r in before.select("doc_id").collect()}
        if name == "near_duplicates":
            want = plain_components(texts_of(before), 5)
            assert ids == {i for (i, n), c in want.items() if i == c}
        if name == "decontamination":
            assert decontamination.find_leaks(out, bench).count() == 0
        if name == "personal_data":
            assert all(not plain_pii(r["text"] or "") for r in rows)
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert all(0 < r["taken"] <= 2 * r["size"] for r in rows)


def test_catalog_names():
    assert [n.split("_")[0] for n in catalog.queries()] == [f"op{n}" for n in range(1, 14)]
    assert isinstance(LinearModel(np.zeros(4, np.float32), 0.0, 1.0, 0.0, 2).probability(np.zeros(1))[0], float)


def test_texts_are_judged_in_little_memory():
    texts = pa.array([" ".join(f"w{(i * 7 + j) % 5003}" for j in range(2_000)) for i in range(300)])
    model = linear.LinearModel(np.zeros(1 << 18, np.float32), 0.0, 1.0, 0.0, 18)
    tracemalloc.start()
    for _, _, part in bytesets.chunks(texts):
        quality_rules.counts(part)
        linear.logits(part, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20  # several of these share an executor
