"""Every operator against a brute-force version, on awkward rows and on an empty table."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from changelake.llm import (bpe, chains, decontaminate, language_id, license_scan, minhash_dedup, personal_data, quality_rules,
                            repeats, substring_dedup, suffix_dedup, toxicity)


def rows_of(df, *cols):
    low = lambda r: tuple((x is not None, x) for x in r)
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=low)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r))


def test_quality_rules(frame, awkward):
    cols = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows_of(quality_rules.judge(frame(awkward)), *cols) == ordered(brute.quality(awkward))
    assert quality_rules.judge(frame([])).count() == 0
    assert not quality_rules.judge(frame([(1, "a$ b# c| " * 20)])).first().kept


def test_quality_rules_use_no_python(frame):
    plan = quality_rules.judge(frame([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_suffix_dedup(frame, awkward):
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert rows_of(suffix_dedup.dedup(frame(awkward)), *cols) == ordered(brute.suffix_dedup(awkward))
    assert suffix_dedup.dedup(frame([])).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_suffix_dedup_on_edited_copies(frame, seed):
    rnd = random.Random(seed)
    texts = ["".join(rnd.choices("ab \n", k=150)) for _ in range(6)]
    rows = []
    for d in range(25):
        t = "".join(rnd.choice(texts) for _ in range(rnd.randint(0, 5)))
        for _ in range(rnd.randint(0, 3)):
            p = rnd.randint(0, len(t))
            t = t[:p] + rnd.choice("abé") + t[p + 1:]
        rows.append((d, t))
    cols = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    got = suffix_dedup.dedup(frame(rows), length=40, piece=8, block=4)
    assert rows_of(got, *cols) == ordered(brute.suffix_dedup(rows, 40))


def test_substring_dedup(frame, awkward):
    cols = ("doc_id", "n_words", "n_removed", "kept_sha256")
    assert rows_of(substring_dedup.dedup(frame(awkward)), *cols) == ordered(brute.substring_dedup(awkward))
    assert substring_dedup.dedup(frame([])).count() == 0


@pytest.mark.parametrize("module, name, check", [(suffix_dedup, "byte-blocks", brute.suffix_dedup),
                                                 (substring_dedup, "word-windows", brute.substring_dedup)])
def test_repeated_rows_add_no_work_per_pair(frame, monkeypatch, module, name, check):
    rnd = random.Random(7)
    words = [f"w{rnd.randint(0, 10 ** 6)}" for _ in range(300)]
    sizes = {}
    monkeypatch.setattr(module, "release", lambda *frames: None, raising=False)
    monkeypatch.setattr(module, "stored", lambda df, n, write=module.stored: sizes.setdefault(n, write(df, n)))
    counts = []
    for copies in (2, 12):
        sizes.clear()
        rows = [(1, " ".join(words))] * copies + [(2, "other start " + " ".join(words[100:190]) + " other end")]
        got = rows_of(module.dedup(frame(rows).coalesce(1)), "doc_id", "n_removed", "kept_sha256")
        want = [(r[0], r[2], r[-1]) for r in check(rows)]
        assert got == ordered(want)
        counts.append(sizes[name].count())
    assert counts[0] == counts[1] > 0


def test_repeat_classes_use_no_window(spark, monkeypatch):
    plans = []
    write = repeats.stored

    def stored(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(repeats, "stored", stored)
    monkeypatch.setattr(repeats, "release", lambda *frames: None)
    rows = spark.createDataFrame([(d, d, 0, 1, 0, 5, d % 3) for d in range(6)] + [(9, 9, 0, 1, 0, 6, 1), (8, 8, 0, 1, 0, 7, 1), (7, 7, 0, 1, 0, 7, 1)], repeats.RUNS)
    got = sorted((r.doc, r.n, r.first_doc, r.first_key, r.mixed) for r in repeats.candidates(rows, "byte").collect())
    assert got == [(d, 2, d % 3, d % 3, True) for d in range(6)] + [(7, 2, 7, 7, False), (8, 2, 7, 7, False)]
    assert plans and not any("Window" in p for p in plans)
    # AQE splits a join that reads plain shuffles only
    assert not any("Join" in p and "Aggregate" in p for p in plans)


def test_minhash_dedup(frame, awkward):
    rnd = random.Random(5)
    base = [f"w{rnd.randint(0, 400)}" for _ in range(150)]
    rows = [r for r in awkward if r[0] is not None]
    for d in range(100, 160):  # a group whose members differ from the base, and more from each other
        t = list(base)
        for _ in range(rnd.randint(0, 14)):
            t[rnd.randrange(len(t))] = f"edit{d}"
        rows.append((d, " ".join(t)))
    got = minhash_dedup.dedup(frame([*rows, (None, "no id here")]), block=16)
    want = brute.near_dedup(rows) + [(None, 2, None, True)]
    assert rows_of(got, "doc_id", "n_shingles", "component_id", "kept") == ordered(want)
    assert minhash_dedup.dedup(frame([])).count() == 0


def test_minhash_dedup_of_repeated_ids_in_any_order(frame):
    rnd = random.Random(8)
    words = lambda n: " ".join(f"w{rnd.randint(0, 5000)}" for _ in range(n))
    one, two, three = words(200), words(200), words(200)
    rows = [(3, one), (5, one), (5, two), (7, two + " more"), (8, three), (9, three), (9, ""), (9, two), (11, words(100))]
    for k in range(40, 60):
        rows.append((k, " ".join([three] + [words(1) for _ in range(rnd.randint(0, 6))])))
        rows.append((rnd.randint(60, 70), words(50)))
        rows.append((rnd.randint(60, 70), words(50)))
    want = None
    for seed in range(2):
        rnd.shuffle(rows)
        got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash_dedup.dedup(frame(rows), block=8).collect())
        assert want is None or got == want
        want = got
    assert [r for r in got if r[1]] == sorted(brute.near_dedup([r for r in rows if r[1]]))
    assert [r for r in got if not r[1]] == [(9, 0, 9, True)]
    assert {c for d, n, c, _ in got if n and d in (3, 5, 7, 8, 9)} == {3}


def test_decontaminate(spark, frame, awkward):
    items = [(1, "word1 and then word2 and then word3 and then word4 and then word5 and"), (2, "x"), (3, None), (4, ""),
             (None, "with words"), (5, "WORD7 and, then"), (5, "WORD7 and, then")]
    bench = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string")
    got = decontaminate.scan(frame(awkward), bench)
    want = []
    windows = set()
    for i, t in items:
        w = brute.LOWERED.findall(brute.lower_az(t))
        n = min(13, len(w))
        if i is not None and n:
            windows |= {(i, tuple(w[p:p + n])) for p in range(len(w) - n + 1)}
    for d, t in awkward:
        w = brute.LOWERED.findall(brute.lower_az(t))
        hit, ids = set(), set()
        for i, q in windows:
            for p in range(len(w) - len(q) + 1):
                if tuple(w[p:p + len(q)]) == q:
                    hit |= set(range(p, p + len(q)))
                    ids.add(str(i))
        want.append((d, len(w), len(hit), len(ids), brute.sha(",".join(sorted(ids))), len(hit) > 0 and 20 * len(hit) >= len(w)))
    assert rows_of(got, "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated") == ordered(want)
    near = decontaminate.scan(frame([(1, "word1 and then odd word2 and then word3 and then word4 and then word5 and")]), bench).first()
    assert near.n_near >= 1 and near.n_hit == 0
    assert decontaminate.scan(frame([]), bench).count() == 0
    assert decontaminate.scan(frame(awkward), bench.limit(0)).where("n_hit > 0").count() == 0


def test_decontaminate_counts_items_without_id_as_its_sql_does(spark, frame, tmp_path):
    import duckdb

    import corpus_pipeline
    texts = ["some with words here", "three more words with words and x", "clean", "only three more"]
    docs = frame(list(enumerate(texts)))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    bench = spark.createDataFrame([(None, "with words"), (None, "three more"), (5, "x"), (6, "words here")], "item_id long, text string")
    bench.coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = con.sql(decontaminate.ORACLE_SQL)
    assert rows_of(decontaminate.query(spark, str(tmp_path)), *want.columns) == ordered(want.fetchall())
    assert [r.doc_id for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()] == [2]


def test_decontaminate_returns_its_matches_whatever_the_parts(spark, frame, monkeypatch):
    items = [(k, " ".join(f"t{k}x{j}" for j in range(13))) for k in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    near = lambda t: " ".join(t.split()[:6] + ["odd"] + t.split()[6:])
    docs = frame([(1, "lead " + " ".join(near(t) for _, t in items)), (2, "lead in " + items[3][1] + " end"), (2, "lead in " + items[3][1] + " end"),
                  (3, "x")])
    got, counts = [], []
    for size in (decontaminate.PART_BYTES, 100):  # one part, and several
        monkeypatch.setattr(decontaminate, "PART_BYTES", size)
        found = decontaminate.matches(docs, bench).collect()
        got.append(sorted((r.doc_id, r.item, r.start, r.end, r.exact) for r in found))
        counts.append(sorted((r.doc_id, r.n_hit, r.n_items, r.n_near) for r in decontaminate.scan(docs, bench).collect()))
    assert got[0] == got[1] and counts[0] == counts[1]
    assert [g for g in got[0] if g[0] == 2] == [(2, 3, 2, 15, True)]
    assert {(g[1], g[4]) for g in got[0] if g[0] == 1} == {(k, False) for k in range(12)}
    assert all(e - s == 13 and abs(s - (1 + 14 * k)) <= 1 for d, k, s, e, _ in got[0] if d == 1)
    assert counts[0] == [(1, 0, 0, len([g for g in got[0] if g[0] == 1])), (2, 13, 1, 0), (2, 13, 1, 0), (3, 0, 0, 0)]
    # the two halves of a window in two documents are no match
    split = [(1, " ".join(items[0][1].split()[:12]) + " y"), (2, items[0][1].split()[12])]
    assert decontaminate.matches(frame(split).coalesce(1), bench).count() == 0


def test_license_scan(frame, awkward):
    rows = [*awkward, (50, "intro " * 60 + license_scan.TEMPLATES["mit"]), (51, "See CC\nBY, and the General Public License. " * 3),
            (52, "all rights, all rights reserved" + " filler" * 300 + " cc by")]
    got = license_scan.scan(frame(rows))
    cols = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    assert rows_of(got, *cols) == ordered(brute.license_scan(rows, license_scan.TEMPLATES, license_scan.PHRASES))
    assert license_scan.scan(frame([])).count() == 0


def test_license_scan_finds_long_templates_at_any_place(frame):
    long = {"whole": " ".join(f"term{k}" for k in range(200)), "half": " ".join(f"part{k}" for k in range(100))}
    rows = [(100 * (name == "half") + k, "intro " * (k * 13) + text + " outro" * 90) for name, text in long.items() for k in range(20)]
    got = {r.doc_id: (r.labels, r.score) for r in license_scan.scan(frame(rows), templates=long).collect()}
    assert got == {d: ("half" if d >= 100 else "whole", 1.0) for d, _ in rows}


def test_bpe_equals_the_library(frame, awkward):
    rnd = random.Random(1)
    letters = ["a", "e", "s", "th", "ing", "é", "ß", " ", "Σ", "1", "'s", "!", " ", "İ", "한", "😀", "<|endoftext|>", "é", "\x1c"]
    rows = [*awkward, *((100 + k, "".join(rnd.choices(letters, k=rnd.choice([3, 50, 4000])))) for k in range(40)),
            *((200 + k, "".join(rnd.choices("aeinrst"[:k + 1], k=6000))) for k in range(7))]
    library = Tokenizer.from_file(bpe.vocabulary_path())
    library.no_truncation(), library.no_padding()
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     brute.sha(library.decode(ids, skip_special_tokens=False))))
    got = bpe.code(frame(rows), bpe.vocabulary_path())
    assert rows_of(got, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == ordered(want)
    assert bpe.code(frame([]), bpe.vocabulary_path()).count() == 0


def test_bpe_streams_and_decodes_to_text():
    vocabulary = bpe.load(bpe.vocabulary_path())
    encoder, decoder = bpe.Encoder(vocabulary), bpe.Decoder(vocabulary)
    word = ("strength" * 2000).encode()
    whole = encoder._merged([*(encoder.inner[c] for c in word[:-1]), encoder.final[word[-1]]])
    assert list(encoder.stream(iter(word))) == whole
    assert "".join(decoder.text(encoder.encode("Naïve 中文 text"))) == "naïve 中文 text "


def test_personal_data(frame, awkward):
    rows = [(1, "a@b.co 1.2.3.4 999.1.1.1 +49 (170) 1234567, 4111 1111 1111 1111"), (2, "mail john [at] example (dot) com now"),
            (3, "рaul@ехample.com"), (4, "４１１１ １１１１ １１１１ １１１１"), (5, "plus four nine one seven two three four five six"),
            (6, "jo​hn@example.com"), (7, "clean text at the door. Then on.")]
    got = {r.doc_id: r for r in personal_data.scan(frame(rows)).collect()}
    assert (got[1].n_email, got[1].n_ip, got[1].n_phone) == (1, 1, 1)
    assert got[2].spans == "email:5:32" and got[2].redacted == "mail [EMAIL] now" and got[2].n_email == 0
    assert [got[d].spans.split(":")[0] for d in (3, 4, 5, 6)] == ["email", "card", "phone", "email"]
    assert got[7].spans == "" and got[7].base_sha256 == brute.sha("")
    assert personal_data.scan(frame(awkward)).count() == len(awkward)
    assert personal_data.scan(frame([])).count() == 0


def test_personal_data_disguised_in_part(frame):
    rows = [(1, "to jo\u200bhn@example.com."), (2, "to j\u043ehn@example.com."), (3, "to john@mail.example[dot]com now"),
            (4, "call +49 170 1234\uff15\uff16\uff17 now"), (5, "to john@example.com and a\u200bb"),
            (6, "call +49 170 1234567, jo\u200bhn@example.com or 1.2.3.4"), (7, "call plus four.nine.one.seven.two.three.four.five six now"),
            (8, "(plus four nine one seven two three four five) six")]
    want = {1: ("email:3:20,email:6:20", "to [EMAIL]."), 2: ("email:3:19,email:5:19", "to [EMAIL]."),
            3: ("email:3:20,email:3:28", "to [EMAIL] now"), 4: ("phone:5:17,phone:5:20", "call [PHONE] now"),
            5: ("email:3:19", "to [EMAIL] and a\u200bb"),
            6: ("email:22:39,email:25:39,ip:43:50,phone:5:20", "call [PHONE], [EMAIL] or [IP]"),
            7: ("phone:5:53", "call [PHONE] now"), 8: ("phone:1:45", "([PHONE]) six")}
    got = {r.doc_id: r for r in personal_data.scan(frame(rows)).collect()}
    assert {d: (r.spans, r.redacted) for d, r in got.items()} == want
    for d, text in rows:
        base = personal_data.find(text)
        assert (got[d].n_email, got[d].n_ip, got[d].n_phone) == tuple(len(base[k]) for k in ("email", "ip", "phone"))
        assert got[d].base_sha256 == brute.sha(personal_data._joined(base))
    assert personal_data.redact("0123456789", {"email": [(1, 4)], "ip": [], "card": [(3, 8)], "phone": []}) == "0[CARD]89"


def test_personal_data_gate_is_no_narrower_than_the_spelled_runs():
    rnd = random.Random(3)
    parts = [*personal_data.SPELLED, "4", "x", "plus", "+", " ", " ", "-", ".", "(", "Six", "\u017fix", "FÜNF"]
    # the runs as one pattern, which takes quadratic time on long texts
    digit, word = personal_data._DIGIT, "|".join(personal_data.SPELLED)
    whole = re.compile(rf"(?i)(?<!\w)(?:(?:plus|\+)[ ]?)?{digit}(?:[ .-]{{1,2}}{digit})*[ -]{{1,2}}(?:{word})(?:[ .-]{{1,2}}{digit})*(?!\w)")
    found = 0
    for _ in range(30_000):
        text = "".join(rnd.choices(parts, k=rnd.randint(2, 7)))
        folded = text.translate(personal_data.FOLD)
        assert list(personal_data._runs(folded)) == [m.span() for m in whole.finditer(folded)], text
        if whole.search(folded):
            found += 1
            assert personal_data._disguised(text), text
    assert found > 300


def test_language_id(frame, awkward):
    en = frame([(i, "the house and the garden with thing of " * 5) for i in range(9)], "en")
    de = frame([(i + 20, "der garten und das haus mit schönen dingen " * 5) for i in range(9)], "de")
    model = language_id.train(en.unionByName(de))
    from pyspark.sql import functions as F
    mixed = "the house and the garden with thing " * 4 + "der garten und das haus mit schönen dingen " * 2
    got = {r.key: r for r in language_id.detect(frame([(1, mixed), (2, "123 !"), (3, None), (4, "中文"), (5, "das schöne haus")]), model, F.col("doc_id")).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 5)] == ["en", "und", "und", "de"]
    assert got[4].lang_pred in ("de", "en") and got[4].score == 0
    assert [s.lang for s in got[1].spans] == ["en", "de"]
    assert language_id.detect(frame(awkward), model, F.col("doc_id")).count() == len(awkward)
    assert language_id.detect(frame([]), language_id.train(frame([])), F.col("doc_id")).count() == 0
    assert {r.lang_pred for r in language_id.detect(frame(awkward), language_id.train(frame([])), F.col("doc_id")).collect()} == {"und"}


def test_viterbi_labels_do_not_wrap():
    scores = np.zeros((3, 300), np.float32)
    scores[0, 10], scores[1:, 299] = 5, 5
    assert chains.best_path(scores, np.array([0, 3]), 1.0).tolist() == [10, 299, 299]


def test_toxicity(spark, frame, awkward):
    rnd = random.Random(2)
    plain = ["the", "house", "garden", "walk", "river", "stone", "cloud", "table"]
    docs, labels = [], []
    for d in range(400):
        bad = d % 4 == 0
        words = rnd.choices(plain, k=60)
        if bad:
            for _ in range(3):
                words[rnd.randrange(60)] = rnd.choice(["grobiana", "grobianok", "grobianu", "schuft"])
        docs.append((d, " ".join(words)))
        labels.append((d, int(bad)))
    frame_ = frame(docs)
    marked = spark.createDataFrame(labels + [(0, 1), (None, 1), (9999, 0), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(marked.where("doc_id < 300 or doc_id is null"), frame_)
    unseen = [(1, "the river and a grobianello by the stone"), (2, "the river by the stone"), (3, None), (4, "")]
    got = {r.doc_id: r for r in toxicity.score(frame(unseen), model).collect()}
    assert [got[k].predicted for k in (1, 2, 3, 4)] == [1, 0, 0, 0]
    assert [unseen[0][1][s.start:s.end] for s in got[1].spans] == ["grobianello"]
    scored = {r.doc_id: r.predicted for r in toxicity.score(frame_, model).collect()}
    assert all(scored[d] == t for d, t in labels if d >= 300)
    assert toxicity.score(frame(awkward), model).count() == len(awkward)
    none = toxicity.fit(marked.limit(0), frame_)
    assert {r.score for r in toxicity.score(frame(awkward), none).collect()} == {0.0}


def test_texts_whose_keys_collide_keep_apart(spark, frame, monkeypatch):
    """Rows are joined by id and key, so one key for every text changes nothing."""
    for module in (repeats, decontaminate):
        monkeypatch.setattr(module, "row_key", lambda *columns: F.lit(7).cast("long"))
    passage = " ".join(f"w{k}" for k in range(70))
    rows = [(1, passage), (2, "other " * 3 + passage + " end"), (3, "short"), (4, None), (5, "x" * 500), (6, "lead " + passage[:300] + "z" * 90)]
    for module, check in ((suffix_dedup, brute.suffix_dedup), (substring_dedup, brute.substring_dedup)):
        want = check(rows)
        out = module.dedup(frame(rows))
        columns = [c for c in out.columns if not c.startswith("kept") or c == "kept_sha256"]
        assert rows_of(out, *columns) == ordered(want)
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = {r.doc_id: (r.n_hit, r.contaminated) for r in decontaminate.scan(frame(rows), bench).collect()}
    assert got[1] == (70, True) and got[2] == (70, True) and got[3] == got[4] == got[5] == (0, False)


def test_spans_beyond_their_text_are_refused():
    from changelake.llm import kernels

    with pytest.raises(ValueError):
        kernels.covered(np.array([0]), np.array([5]), 4)
    assert not kernels.covered(np.array([], int), np.array([], int), 0).any()
