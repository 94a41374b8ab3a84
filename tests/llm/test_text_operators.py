import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from clickloom.llm import decontaminate, token_records
from clickloom.llm.decontaminate import contamination, suffix_order
from clickloom.llm.language import predict_language
from clickloom.llm import main_text as main_text_module
from clickloom.llm.main_text import main_text
from clickloom.llm.mixture import mix, targets
from clickloom.llm.shards import shards
from clickloom.llm.toxicity import toxicity
from clickloom.session import shared_path

tokenizers = pytest.importorskip("public_tokenizers")
BPE = tokenizers.path("byte_bpe_50k.json")


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BPE)


def test_both_libraries_cut_the_same_characters():
    own, tok = token_records.Encoder(BPE), library()
    for at in range(1, token_records._AGREED, 16):
        text = "".join(f"a{chr(k)}b {chr(k)}1{chr(k)}{chr(k)} " for k in range(at, min(at + 16, token_records._AGREED)))
        assert own.encode(text) == np.array(tok.encode(text, add_special_tokens=False).ids, own.kind).tobytes(), at


@pytest.mark.parametrize("text", ["", " ", "\n", "a\n \nb", "a   b", "don't we'll  x\t\ty ", "x<|endoftext|>y", "日本語 text é", " a b", "a\nb\n", "1 2\n3", "''s '", "emoji 🙂 x"])
def test_encoding_is_that_of_the_library(text):
    own = token_records.Encoder(BPE)
    for _ in range(2):
        assert own.encode(text) == np.array(library().encode(text, add_special_tokens=False).ids, own.kind).tobytes()


def test_no_piece_reaches_over_the_place_before_a_space_that_a_character_follows():
    tok = library()
    ids = lambda texts: [x.ids for x in tok.encode_batch_fast(texts, add_special_tokens=False)]
    for before in ("a", "1", "'", "a ", "a\n", "a\t", "\r", "\xa0"):
        (first,) = ids([before])
        after = [f"{x}{chr(k)}b" for x in " \n" for k in (*range(1, 0xD800, 7), *range(0xE000, 0x110000, 977), *range(1, token_records._AGREED)) if not chr(k).isspace()]
        assert ids([before + x for x in after]) == [first + x for x in ids(after)]


def test_texts_of_many_kinds_are_encoded_together_as_by_the_library(monkeypatch):
    rng, tok = random.Random(9), library()
    kinds = ["a", "word", "Wörter,", "don't", "12", " ", "  ", "\n", "\n\n", "\r\n", "\t", "\x1c", "\x85", "\xa0", "\u2003", "\u2019s", "日本", "🙂", "x" * 70, "<|endoftext|>", "<|endof", ".", "'"]
    texts = [None, "", *("".join(rng.choice(kinds) + rng.choice(["", " ", " ", "\n"]) for _ in range(rng.randrange(12))) for _ in range(3000))]
    monkeypatch.setattr(token_records, "CACHE_PARTS", 200)
    monkeypatch.setattr(token_records, "JOINED", 7)
    own = token_records.Encoder(BPE)
    want = [np.array(tok.encode(x or "", add_special_tokens=False).ids, own.kind).tobytes() for x in texts]
    for k in (1, 50, 3002):
        assert [x for i in range(0, len(texts), k) for x in own.encode_all(pa.array(texts[i : i + k]))] == want


def test_the_library_gets_each_part_once_and_many_at_a_time(monkeypatch):
    own, asked = token_records.Encoder(BPE), []
    monkeypatch.setattr(own, "_ids", lambda text, f=own._ids: asked.append(text) or f(text))
    own.encode_all(pa.array([f"The \u2019quoted\u2019 words{k % 40} come\nagain, words{k % 40}" for k in range(2000)]))
    assert len(asked) == 2000 + 1 and sum("quoted" in x for x in asked) == 1


def test_records_come_back_whole_and_in_order(spark, odd, nothing, monkeypatch):
    monkeypatch.setattr(token_records, "BLOCK_BYTES", 2000)
    path = shared_path(spark, "records")
    token_records.write_records(odd, path, BPE)
    index = token_records.build_index(spark, path, BPE)
    rows = index.orderBy("start").collect()
    want = sorted((-1 if r.doc_id is None else r.doc_id, len(e.ids) + 1) for r, e in ((r, library().encode(r.text or "", add_special_tokens=False)) for r in odd.collect()))
    assert [(-1 if r.doc_id is None else r.doc_id, r.n_tokens) for r in rows] == want
    assert [r.start for r in rows] == [sum(n for _, n in want[:k]) for k in range(len(want))]
    back = {r.doc_id: r.ids for r in token_records.read_shuffled(spark, path, index.where("doc_id in (1, 5)"), BPE).collect()}
    assert back[1] == [*library().encode("one two three four five", add_special_tokens=False).ids, 0]
    assert zlib.crc32(np.array(back[5], "<u4").tobytes()) == next(r.ids_crc32 for r in rows if r.doc_id == 5)
    assert token_records.token_records(nothing, BPE).count() == 0


def test_a_damaged_record_is_an_error():
    good = token_records.frame(4, b"\x01\x00") + token_records.frame(None, b"")
    assert [(x[2], x[3]) for x in token_records.frames(good)] == [(4, b"\x01\x00"), (None, b"")]
    with pytest.raises(ValueError, match="byte 0"):
        list(token_records.frames(good[:14] + b"\xff" + good[15:]))


PAGE = (
    "<html><head><title>t{k}</title><style>p{{}}</style><script>var a='</p>';</script></head><body><nav><ul><li>Home</ul></nav>"
    "<!-- x --><div class='ad'>Buy {k}</div>{main}<form><input>send</form><footer>&copy; us {k}</footer></body></html>"
)


def extract(spark, sources: list[str]) -> list[str]:
    """Main texts of pages of one host."""
    pages = spark.createDataFrame([(k, "http://a.example/", x) for k, x in enumerate(sources)], "page_id long, url string, html string")
    return [row.text for row in sorted(main_text(pages.repartition(3)).collect())]


def test_main_text_of_articles(spark):
    sources = [PAGE.format(k=k, main=f"<article><h1>T{k}</h1><p>A &amp; <b>b{k}</b>c<br>d\n e<p>f<div class='comments'>no</div></article>") for k in range(5)]
    assert extract(spark, sources) == [f"T{k} A & b{k}c d e f" for k in range(5)]
    assert extract(spark, sources[:1]) == ["T0 A & b0c d e f"]


def test_main_text_without_articles_leaves_out_the_template(spark):
    sources = [PAGE.format(k=k, main=f"<div id=x><p>Read our rules</p><p>{'word ' * 9}{k} is it</p><p>and {k * 7}</p></div>") for k in range(6)]
    assert extract(spark, sources) == [f"{'word ' * 9}{k} is it and {k * 7}" for k in range(6)]


def test_main_text_of_two_layouts_and_of_copies(spark):
    texts = [f"{'word ' * 9}{k} is it" for k in range(9)]
    bodies = ["<div id=x><p>{}</p></div>"] * 6 + ["<section><div class=story><p>{}</p></div></section>"] * 3
    sources = [PAGE.format(k=k, main=body.format(text)) for k, (body, text) in enumerate(zip(bodies, texts, strict=True))]
    assert extract(spark, sources) == texts
    other = "<html><body><table><tr><td>quite another site</td></tr></table></body></html>"
    assert extract(spark, [*sources, other]) == [*texts, "quite another site"]
    assert extract(spark, sources[:1] * 3) == texts[:1] * 3
    assert extract(spark, sources[:6] + sources[:1] * 9) == texts[:6] + texts[:1] * 9


def test_template_decides_inside_articles(spark):
    """A notice without a listed class goes from enough pages on; passages of some pages and names with another head stay."""
    def page(k):
        seen = "<p>A passage that many pages share.</p>" if k % 3 else ""
        return PAGE.format(k=k, main=f"<article><div class=box>We ask you to register</div><p>Text {k} here.</p>{seen}<div class='legal-history'><p>Act {k}</p></div><div class='story-comments'>so {k}</div></article>")

    def text(k, notice=""):
        return f"{notice}Text {k} here. {'A passage that many pages share. ' if k % 3 else ''}Act {k}"

    assert extract(spark, [page(k) for k in range(12)]) == [text(k) for k in range(12)]
    # one copy more of a page is no evidence
    assert extract(spark, [page(k) for k in range(9)] + [page(0)] * 5) == [text(k, "We ask you to register ") for k in [*range(9), 0, 0, 0, 0, 0]]


def brute_template(sources: list[str]) -> set[int]:
    """The template of a host's pages, all held in one place and compared place by place."""
    module = main_text_module
    pages = list({p["digest"]: p for p in map(module._parsed, sources)}.values())
    where = [{t: [k for k, x in enumerate(p["tokens"]) if x == t] for t in set(p["tokens"]) - {0}} for p in pages]
    classes = {}
    for t in set().union(*where):
        vector = tuple(len(w.get(t, ())) for w in where)
        on = sum(map(bool, vector))
        if on >= module.SUPPORT * len(pages) and (module._is_tag(t) or on >= module.STRING_PAGES):
            classes.setdefault(vector, set()).add(t)
    valid = {}
    for vector, tokens in classes.items():
        if not any(map(module._is_tag, tokens)):
            continue
        on = [k for k, n in enumerate(vector) if n]
        first = min(on, key=lambda k: pages[k]["digest"])
        order, out = sorted(tokens, key=lambda t: where[first][t][0]), set()
        for k in on:
            rounds = before = where[k][order[0]]
            for t in order[1:]:
                places = where[k][t]
                if all(b < p and (r + 1 == len(rounds) or p < rounds[r + 1]) for r, (b, p) in enumerate(zip(before, places, strict=True))):
                    before = places
                else:
                    out.add(t)
        order = [t for t in order if t not in out]
        if any(map(module._is_tag, order)):
            valid[vector] = order
    if not valid:
        return set()
    most = max((sum(map(bool, v)), len(order)) for v, order in valid.items())
    assert sum((sum(map(bool, v)), len(order)) == most for v, order in valid.items()) == 1, "the fixture has one frame"
    frame = next(v for v, order in valid.items() if (sum(map(bool, v)), len(order)) == most)
    found = set(valid[frame])
    for vector, order in valid.items():
        gaps = set()
        for k, n in enumerate(vector if vector != frame else ()):
            for r in range(n):
                begin, end = where[k][order[0]][r], where[k][order[-1]][r]
                spans = [
                    (a, b) for a, b in zip(valid[frame], valid[frame][1:], strict=False)
                    for x, y in zip(where[k].get(a, ()), where[k].get(b, ()), strict=True) if x < begin and end < y
                ]
                gaps.add(spans[0] if spans else None)
        if len(gaps) == 1 and None not in gaps:
            found |= set(order)
    return found


@pytest.mark.parametrize("seed", range(3))
def test_template_is_that_of_brute_force(spark, seed):
    rng = random.Random(seed)
    boxes = ["<div class=a><p>{}</p></div>", "<section><h2>Part</h2><p>{}</p></section>", "<ul><li>{}</li><li>fixed</li></ul>", "<div class=q><i>Note</i> {}</div>"]
    hosts = {}
    for h in range(6):
        count = rng.choice([1, 2, 4, 9, 15])
        hosts[h] = [
            PAGE.format(k=k, main="".join(x.format(rng.randrange(4)) for x in rng.choices(boxes, k=rng.randrange(5)))) for k in range(count)
        ] + [PAGE.format(k=0, main="")] * rng.randrange(3)
    rows = [(k, f"http://h{h}/{k}", x) for h, sources in hosts.items() for k, x in enumerate(sources)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    parsed = main_text_module.parse(pages)
    found = {r.site: set(r.fixed) for r in main_text_module.templates(parsed).collect()}
    sites = {r.url.split("/")[2]: r.site for r in parsed.select("url", "site").collect()}
    assert [found.get(sites[f"h{h}"], set()) for h in hosts] == [brute_template(sources) for sources in hosts.values()]


def test_main_text_of_odd_pages(spark):
    rows = [(1, None, None), (2, "http://a.b/c", ""), (3, "x", "a < b &lt; c"), (3, "x", "a < b &lt; c"), (None, "http://a.b/d", "<article>" + "<p>y" * 20_000)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, text string")
    found = sorted((r.page_id or 0, r.text, r.n_chars) for r in main_text(pages).collect())
    assert found[1:] == [(1, "", 0), (2, "", 0), (3, "a < b < c", 9), (3, "a < b < c", 9)]
    assert found[0][2] == 39_999
    assert main_text(pages.limit(0)).count() == 0


def test_toxic_words_are_learnt(spark, odd, nothing):
    rng = random.Random(3)
    plain, bad = [f"{a}{b}" for a in "lo mi ta re su na".split() for b in "ka pen dor fil gu".split()], ["grobnak", "zzurp", "vexhole"]
    rows, labels = [], []
    for k in range(900):
        toxic = k % 6 == 0
        words = [rng.choice(plain) for _ in range(rng.randrange(3, 120))]
        for _ in range(1 + len(words) // 30 if toxic else 0):
            words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    found = toxicity(docs, known.where("doc_id % 3 <> 1")).where("doc_id % 3 = 1").collect()
    right = sum(r.predicted == (r.doc_id % 6 == 0) for r in found)
    assert right >= 0.97 * len(found) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in found)
    out = toxicity(odd, known, docs)
    assert out.columns == [c for c in odd.columns if c != "score"] + ["score", "predicted"]
    assert len({r.score for r in out.collect() if not (r.text or "").strip()}) == 1
    assert {r.predicted for r in toxicity(odd, known.limit(0)).collect()} == {0}
    assert toxicity(nothing, known).count() == 0


def test_rare_markers_are_learnt_at_the_full_sample():
    from clickloom.llm.toxicity import SAMPLE, marking_words

    rng = random.Random(7)
    plain = [f"{a}{b}{c}" for a in "lo mi ta re su na".split() for b in "ka pen dor fil gu".split() for c in "ba ce di".split()]
    toxic, ordinary = ([" ".join(rng.choices(plain, k=12)) for _ in range(SAMPLE[label])] for label in (1, 0))
    for k in range(30):  # one text in a hundred
        toxic[k * 100] += " grobnak"
    copies = " ".join(rng.choices(plain, k=40)) + " vexhole"
    for k in range(40):  # near copies are no evidence of their words
        toxic[k * 70 + 1] = f"{copies} {k}"
    assert marking_words(toxic, ordinary) == [b" grobnak "]


def test_the_toxic_dictionary_holds_its_words_whatever_their_number(monkeypatch):
    from clickloom.llm import toxicity as module

    rng = random.Random(5)
    marks = [(" " + "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(5, 10))) + " ").encode() for _ in range(10_000)]
    monkeypatch.setattr(module, "marking_words", lambda *_: marks)
    model = object.__new__(module.Model)
    ordinary = [" ".join(random.Random(k).choices(["some", "words", "of", "plain", "text", "here"], k=40)) for k in range(50)]
    model.shared, model.toxic = module.Model._dictionaries(["bad"], ordinary, {})
    assert model.toxic == b"".join(marks)
    model.compressors = None
    distance = model._distance()
    assert all(distance(word) >= module.FAR for word in marks[::97])  # the rarest, in front, as well as the last


def test_languages_are_told_apart(spark, odd, nothing):
    texts = {"xx": "the cat sat on the mat and then ran", "yy": "der hund und die katze sind nicht hier", "zz": "le chat est sur la table avec une souris"}
    rng = random.Random(1)
    rows = [(" ".join(rng.choices(t.split(), k=12)), lang) for lang, t in texts.items() for _ in range(40)]
    train = spark.createDataFrame(rows, "text string, lang string")
    docs = spark.createDataFrame([(i, " ".join(rng.choices(texts[lang].split(), k=5)), lang) for i, lang in enumerate(list(texts) * 10)], "doc_id bigint, text string, lang string")
    found = predict_language(docs, train).collect()
    assert all(r.lang_pred == r.lang and 0 < r.score <= 1 for r in found)
    out = {r.doc_id: (r.lang_pred, r.score) for r in predict_language(odd, train).collect()}
    assert out[2] == out[3] == out[4] == out[8] == ("und", 0.0) and out[1][0] in texts
    assert {r.lang_pred for r in predict_language(odd, train.limit(0)).collect()} == {"und"}
    assert predict_language(nothing, train).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_suffixes_are_sorted(seed):
    x = np.random.default_rng(seed).integers(0, 3, 60)
    assert suffix_order(x).tolist() == sorted(range(60), key=lambda k: x[k:].tolist())


def test_contamination_is_that_of_all_windows(spark, odd, nothing, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 3000)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 60)
    rng = random.Random(8)
    vocabulary = "a b c d é-f G".split()
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice((2, 5, 13, 20, 40))))) for k in range(12)] + [(99, None), (None, "q r s"), (98, "?!")]
    rows = []
    for k in range(80):
        w = rng.choices(vocabulary, k=rng.randrange(0, 60))
        if k % 3 == 0:
            w[5:5] = (rng.choice(items)[1] or "").upper().split()
        rows.append((k, " ".join(w)))
    cut = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = {k: k + 32 for k in range(65, 91)}
    tests = [("" if i is None else str(i), cut.findall((t or "").translate(lower))) for i, t in items]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    for r in contamination(spark.createDataFrame(rows, "doc_id bigint, text string"), bench).collect():
        w = cut.findall(r.text.translate(lower))
        hit, found, longest = set(), set(), 0
        for name, words in tests:
            size = min(13, len(words))
            for a in range(len(words) - size + 1) if words else ():
                for b in range(len(w) - size + 1):
                    if w[b : b + size] == words[a : a + size]:
                        hit.update(range(b, b + size))
                        found.add(name)
                        n = size
                        while a + n < len(words) and b + n < len(w) and words[a + n] == w[b + n]:
                            n += 1
                        longest = max(longest, n)
        assert (r.n_words, r.n_hit, r["items"], r.longest) == (len(w), len(hit), sorted(found), longest)
        assert r.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert r.contaminated == (len(hit) > 0 and 20 * len(hit) >= len(w))
        if longest:
            words = dict(tests)[r.longest_item]
            assert words[r.item_start : r.item_start + longest] == w[r.doc_start : r.doc_start + longest]
    assert contamination(odd, bench).count() == 11 and contamination(nothing, bench).count() == 0
    assert contamination(odd, bench.limit(0)).where("n_hit > 0").count() == 0


def test_the_longest_match_is_that_of_each_document(spark):
    words = [f"w{k}" for k in range(60)]
    bench = spark.createDataFrame([("i", " ".join(words)), ("j", " ".join(words[30:] + words[:30]))], "item_id string, text string")
    parts = {0: (0, 50), 1: (0, 20), 2: (10, 23), 3: (5, 17), 4: (30, 60), 5: (32, 47)}
    rows = [(k, " ".join(["x"] * k + words[a:b] + ["y"] * 3)) for k, (a, b) in parts.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    found = {r.doc_id: (r.longest, r.longest_item, r.item_start, r.doc_start) for r in contamination(docs, bench).collect()}
    want = {k: (b - a, "i", a, k) for k, (a, b) in parts.items()}
    assert found == want | {3: (0, None, None, None)}


def test_water_is_filled_to_the_caps(spark):
    sizes = spark.createDataFrame([("a", 100), ("b", 1000), ("c", 10), (None, 0), ("d", 5000)], "source string, source_size bigint")
    found = {r.source: r.target for r in targets(sizes, (1, 2, 3), 3).collect()}
    assert found["c"] == 30 and found[None] == 0 and found["a"] == 300 and found["b"] == 3000 and found["d"] == 2780
    assert sum(found.values()) == 6110


def test_mixing_reaches_its_targets_and_repeats(spark, odd, nothing):
    rng = random.Random(2)
    rows = [(k, " ".join(["w"] * rng.randrange(1, 30)), rng.choice("aabbbbbbcd")) for k in range(1500)] + [(5000, "w " * 400, "d")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    one, two = mix(docs).collect(), mix(docs.repartition(7)).collect()
    assert {r.doc_id: r.taken for r in one} == {r.doc_id: r.taken for r in two}
    taken, largest = collections.Counter(), collections.Counter()
    for r in one:
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken == r.size * r.repeats <= 3 * r.size and r.target <= 3 * r.source_size
    assert all(abs(taken[r.source] - r.target) <= largest[r.source] for r in one)
    out = mix(odd.withColumn("size", F.lit("z")))
    assert out.count() == 11 and {r.size for r in out.where("doc_id in (2, 3, 4, 9)").collect()} == {0}
    assert mix(nothing).count() == 0


def test_shards_fit_and_split_only_where_needed(spark, odd, nothing):
    rows = [(k, "x" * (k % 97)) for k in range(4000)] + [(9000, "y" * 9000)] + [(7000, "z" * 40)] * 1000 + [(7001, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = shards(docs, 4000).collect()
    assert len(found) == len(rows)
    total, count = collections.Counter(), collections.Counter()
    for r in found:
        total[r.shard] += r.doc_bytes
        count[r.shard] += 1
    for r in found:
        assert (r.shard_bytes, r.shard_rows) == (total[r.shard], count[r.shard])
        assert r.shard_bytes <= 4000 or r.shard_rows == 1
        bits = r.shard.split("-")[0]
        assert len(bits) == r.depth
    # The parent of a shard was too large.
    for shard in {r.shard.split("-")[0] for r in found}:
        assert not shard or sum(n for s, n in total.items() if s.startswith(shard[:-1])) > 4000
    out = shards(odd, 1 << 20)
    assert out.count() == 11 and {r.shard for r in out.collect()} == {""} and out.columns[:6] == [c for c in odd.columns if c != "depth"]
    assert shards(nothing).count() == 0


def test_fractions_and_roman_numerals_are_no_letters():
    from clickloom.llm.language import grams

    assert all(grams(text) is None for text in ("", " 12 ", "\u00bd \u00b2", "\u2167 -- 3"))
    assert grams("\u00bd a") is not None and grams("\u4e2d") is not None


def test_kernels_are_those_of_sets_of_ngrams():
    """The hashed kernel, the features and the regressions against the same with sets of strings and dense formulas."""
    from clickloom.llm import language as module

    rng = random.Random(4)
    words = {"x": "lor mip ashta dun ".split(), "y": "éta öno quil brä ".split(), "z": "жук дом лес г12 ".split()}
    texts = [(" ".join(rng.choice(words[lang]).capitalize() + rng.choice("!.,7") for _ in range(rng.randrange(1, 40))), lang) for lang in "xyz" for _ in range(30)]
    model = module.Model([t for t, _ in texts], [lang for _, lang in texts])

    def ngrams(text):
        clean = f" {re.sub(r'[\W\d_]+', ' ', text.lower()).strip()} "
        return {clean[k : k + n] for n in (1, 2, 3) for k in range(len(clean) - n + 1)}

    each = module.LANDMARKS // 3
    marks = [ngrams(t) for lang in "xyz" for t in [t for t, own in texts if own == lang][:each]]
    sets = [ngrams(t) for t, _ in texts]
    exact = np.array([[len(a & b) / (len(a) * len(b)) ** 0.5 for b in marks] for a in sets])
    kernel = model.kernel([module.grams(t) for t, _ in texts])
    assert np.abs(kernel - exact).max() < 0.02  # n-grams that share one of 2**18 hashes
    values, vectors = np.linalg.eigh(kernel[[texts.index(x) for lang in "xyz" for x in [x for x in texts if x[1] == lang][:each]]].astype(float))
    kept = values > values.max() * 1e-6
    features = kernel.astype(float) @ (vectors[:, kept] / np.sqrt(values[kept]))
    wanted = np.array([[own == lang for lang in "xyz"] for _, own in texts], float)
    ridge = features @ np.linalg.solve(features.T @ features / 30 + module.RIDGE * np.eye(features.shape[1]), features.T @ wanted / 30)
    names, scores = model.predict([t for t, _ in texts])
    assert names == ["xyz"[k] for k in ridge.argmax(axis=1)]
    assert np.allclose(scores, ridge.max(axis=1).clip(0, 1), atol=0.02)


def test_language_sample_is_bounded_over_all_languages(spark, monkeypatch):
    from clickloom.llm import language as module

    docs = spark.range(4000).selectExpr("concat('text ', id) as text", "concat('l', id % 8) as lang")
    monkeypatch.setattr(module, "TOTAL_CHARS", 8_000)
    rows = module.training_rows(docs)
    assert 4_000 < sum(len(r.text) for r in rows) < 12_000 and len({r.lang for r in rows}) == 8
    monkeypatch.setattr(module, "TOTAL_CHARS", 10**9)
    assert len(module.training_rows(docs)) == 4000


def test_groups_of_a_host_are_dealt_to_several_tasks_either_way(spark, monkeypatch):
    rows = [(k, f"http://hot/{k}", f"<html><nav>menu</nav><article><p>text {k}</p></article></html>") for k in range(60)]
    pages = spark.createDataFrame(rows + [(60, None, None)], "page_id long, url string, html string")
    for tokens in (10_000, 0):
        monkeypatch.setattr(main_text_module, "BROADCAST_TOKENS", tokens)
        found = main_text_module.main_text(pages)
        assert sorted((r.page_id, r.text) for r in found.collect()) == [(k, f"text {k}") for k in range(60)] + [(60, "")]


def test_items_with_one_preamble_are_not_multiplied_by_documents():
    """Test items that share windows: the result is that of all pairs, the work that of places and items apart."""
    rng = random.Random(3)
    shared = [f"p{k}".encode() for k in range(40)]
    items = [(f"i{k:03}", shared + [f"w{rng.randrange(9)}".encode() for _ in range(20)]) for k in range(300)]
    block = decontaminate.Block(items, 13)
    assert len(block.low) <= 28 + 300 * 20 and len(block.lists) <= 300 + 12 * 300
    texts = ["x " + b" ".join(shared).decode() + f" t{k}" for k in range(200)] + [b" ".join(items[7][1]).decode()]
    shard = decontaminate._Shard(texts)
    shard.take(block)
    n_words, n_hit, names, _, longest, item, item_start, doc_start = shard.rows()
    assert set(n_hit[:200]) == {40} and all(len(x) == 300 for x in names)
    assert (longest[0], item[0], item_start[0], doc_start[0]) == (40, "i000", 0, 1)
    assert (longest[200], item[200], item_start[200], doc_start[200]) == (60, "i007", 0, 0)
