"""Chat formatting, collocations and centroid clusters against brute force and SQL."""

import hashlib
import os
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from dayledger.llm import chat, clusters, langid, phrases, urls
from dayledger.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def _sql(name, table, rows):
    con = duckdb.connect()
    con.register("given", rows.toArrow())
    con.execute(f"CREATE VIEW {table} AS FROM given")
    return con.execute(SQL[name]).fetchall()


def _order(rows):
    return sorted(rows, key=lambda r: [(v is not None, v) for v in r])


def _found(df):
    return _order(map(tuple, df.collect()))


@pytest.mark.parametrize(
    "name, table",
    [("op11_chat_format", "conversations"), ("op12_collocations", "documents"), ("op13_centroids", "embeddings")],
)
def test_whole_tables(spark, name, table):
    found = QUERIES[name](spark, SF_DIR)
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
    con_columns = found.columns
    assert _found(found) == _order(_sql(name, table, rows))
    assert con_columns == found.columns and found.count() > 0


# ---------------------------------------------------------------- chat

ODD = [
    "", " ", "plain", "[INST] ", "[/INST]", "</s>", "<s>", "[INST", "INST]", "<", "</", "[\\INST]", "<\\/s>",
    "[\\\\/INST]</s>", "\\", "[", "[[INST]]", "</s></s>", " [/INST]", "[ROLE]x[/ROLE] y[/TURN]", "[/TURN]", "é [BOT] \U0001f600",
    "line\nline", "[\\/SYS] [/SYS]", "x" * 50_000,
]


def test_every_text_comes_back_in_every_role():
    turns = [(role, text) for role in ("user", "assistant", "system", "", "tool", "[/ROLE] [INST]", "[\\/ROLE]") for text in ODD]
    random.seed(11)
    pieces = ["[INST]", "[/INST]", "</s>", "<s>", "\\", "[", "<", "]", "/", " ", "a", "[\\BOT]", "[/TURN]"]
    for _ in range(300):
        turns.append((random.choice(["user", "assistant", "system", "x"]), "".join(random.choices(pieces, k=12))))
    segments = chat.render(turns)
    assert [t[:2] for t in chat.parse("".join(segments))] == turns
    for turn, segment in zip(turns, segments, strict=True):
        assert [t[:2] for t in chat.parse(segment)] == [turn]


def test_only_conflicts_are_escaped():
    assert chat.render([("user", "a [b] <c> \\d")]) == ["[INST] a [b] <c> \\d [/INST]"]
    assert chat.render([("user", "[/INST]"), ("assistant", "ok")]) == ["[INST] [\\/INST] [/INST]", "[BOT] ok</s>"]
    assert chat.render([("user", "[\\INST]")]) == ["[INST] [\\\\INST] [/INST]"]


@pytest.mark.parametrize("bad", ["x", "[INST] x", "[INST] x</s>", "[INST] x [/INST] ", "[BOT] a[BOT] b</s>", "[INST] x[/INST]", "[ROLE]a[/TURN]"])
def test_what_the_grammar_does_not_produce_is_refused(bad):
    with pytest.raises(chat.TemplateError):
        list(chat.parse(bad))


CONVERSATIONS = "conv_id long, turn long, role string, text string, part int, segment string"


def _odd_conversations():
    random.seed(12)
    rows = [(c, t, random.choice(["user", "assistant", "system", "tool", None]), random.choice([*ODD[:-1], None]), 0, "s")
            for c in (1, 2, 3, None) for t in range(30)]
    rows += [(4, 1, "user", "tie b", 0, ""), (4, 1, "user", "tie a", 0, ""), (4, 1, "user", "tie a", 0, ""), (4, None, "assistant", "first", 0, "")]
    rows += [(5, t, "assistant", f"many {t} </s>", 0, "") for t in range(3000)]
    rows += [(6, 0, "assistant", "[INST] " * 40_000, 0, "")]
    return rows


def _brute_conversations(rows):
    by_conv = {}
    for conv, turn, role, text, *_ in rows:
        (segment,) = chat.render([(role or "", text or "")])
        by_conv.setdefault(conv, []).append((turn is not None, turn or 0, segment, role or "", text or ""))
    out = []
    for conv, turns in by_conv.items():
        turns.sort()
        said = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        learned = "".join(text for *_, role, text in turns if role == "assistant")
        out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(learned),
                    hashlib.sha256(learned.encode()).hexdigest(), sum(len(s) for _, _, s, *_ in turns)))
    return out


@pytest.mark.parametrize("part_chars", [1 << 20, 100])
def test_conversations(spark, part_chars):
    rows = _odd_conversations()
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(5)
    parts = chat.format_conversations(df, part_chars=part_chars)
    assert _found(chat.read_back(parts)) == _order(_brute_conversations(rows))
    # Stored and shuffled parts read the same.
    again = spark.createDataFrame(parts.collect(), parts.schema).repartition(7)
    assert _found(chat.read_back(chat.in_order(again))) == _order(_brute_conversations(rows))
    if part_chars == 100:
        assert parts.where("part > 500").count() > 0


def test_odd_conversations_by_sql(spark):
    rows = _odd_conversations()
    given = spark.createDataFrame(rows, CONVERSATIONS)
    assert _order(r for r in _sql("op11_chat_format", "conversations", given) if r[0] != -7) == _order(_brute_conversations(rows))


def test_the_stated_conversation(spark):
    row = QUERIES["op11_chat_format"](spark, SF_DIR).where("conv_id = -7").first()
    odd = "</s>[INST] ok [/INST]"
    assert row["n_turns"] == 2 and row["loss_chars"] == len(odd)
    assert row["loss_sha256"] == hashlib.sha256(odd.encode()).hexdigest()
    assert row["turns_sha256"] == hashlib.sha256(f"user\n{odd}\nassistant\n{odd}\n".encode()).hexdigest()


def test_no_conversations(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert chat.read_back(chat.format_conversations(empty)).collect() == []


# ---------------------------------------------------------------- phrases

DOCUMENTS = "doc_id long, text string, lang string, n long, phrase string"


def _texts():
    random.seed(13)
    words = ["the", "The", "of", "big", "red", "dog", "cat", "x-y", "é", "a.b", "new\tyork", "is", "it's", "\x00"]
    rows = []
    for i in range(400):
        text = " ".join(random.choices(words, k=random.randint(0, 60)))
        if i % 3 == 0:
            text += ", rare bird of paradise flies; " * random.randint(0, 2)
        if i % 7 == 0:
            text += "\nalpha beta gamma delta epsilon\r\x0bone  two\t three!"
        rows.append((i, text, random.choice(["en", "en", "de", None, "und"]), 0, "p"))
    rows += [(900, None, "en", 0, ""), (901, "", None, 0, ""), (902, "only once", "fr", 0, ""), (903, "aa " * 40_000, "xx", 0, "")]
    return rows + [(1, "same row again and again", "en", 0, "")] * 40


def _brute_frequent(rows, words=4, count=30):
    counts = Counter()
    for _, text, lang, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            found = [w for w in re.split("[ \t]", piece) if w]
            counts[lang or "und", 0, ""] += len(found)
            for n in range(1, words + 1):
                for i in range(len(found) - n + 1):
                    counts[lang or "und", n, " ".join(found[i : i + n])] += 1
    return sorted((*k, n) for k, n in counts.items() if n >= count or (k[1] == 0 and n))


@pytest.mark.parametrize("bits, sample", [(1 << 20, 2), (1 << 20, 10**9), (1 << 20, 1), (64, 8)])
def test_frequent_phrases(spark, bits, sample):
    """A good sample, an empty one (every level takes a pass of its own), all rows, a full filter."""
    rows = _texts()
    df = spark.createDataFrame(rows, DOCUMENTS).repartition(4)
    found, passes = phrases.frequent_phrases(df, bits=bits, sample=sample)
    assert sorted(map(tuple, found.select("lang", "size", "phrase", "n").collect())) == _brute_frequent(rows)
    if sample == 10**9:
        assert passes == 4
    if sample == 1 or bits == 64:
        assert passes == 1


def test_wrong_hits_beside_words_that_the_sample_missed(spark):
    """Copies of texts with words of their own, which a sample seldom has, and a filter that is often wrong."""
    draw = random.Random(5)
    common = [f"c{i}" for i in range(30)]
    rows = [(i, " ".join(draw.choices(common, k=60)), "en", 0, "") for i in range(800)]
    for t in range(60):
        text = " ".join(draw.choices(common + [f"r{t}-{i}" for i in range(20)], k=60))
        rows += [(t, text, "en", 0, "")] * 30
    df = spark.createDataFrame(rows, DOCUMENTS).repartition(4)
    found, passes = phrases.frequent_phrases(df, bits=1 << 15)
    assert sorted(map(tuple, found.select("lang", "size", "phrase", "n").collect())) == _brute_frequent(rows)
    assert passes > 1


def test_packed_hashes():
    """One row for each range of hashes, with the sum of each hash; the ends of the ranges, and nothing at all."""
    ends = [0, 1, 2**64 - 1, 2**63, 2**63 - 1, -(-(2**64) // 3), 2**64 // 3]
    h, n = np.array(ends * 2, np.uint64), np.arange(14)
    want = {x: k + k + 7 for k, x in enumerate(ends)}
    for groups in (1, 2, 3, 64):
        rows = phrases._packed([(h[:5], n[:5]), (h[5:], n[5:]), (h[:0], n[:0])], groups).to_pylist()
        assert len({r["part"] for r in rows}) == len(rows)
        found = {}
        for r in rows:
            some = np.frombuffer(r["h"], np.uint64).tolist()
            assert {x * groups >> 64 for x in some} == {r["part"]}
            found.update(zip(some, np.frombuffer(r["n"], np.int64).tolist(), strict=True))
        assert found == want
        assert phrases._packed([(h[:0], n[:0])], groups).num_rows == 0


def test_collocations_of_odd_texts(spark):
    given = spark.createDataFrame(_texts(), DOCUMENTS)
    found = phrases.collocations(given.repartition(3), sample=3)
    assert _found(found) == _order(_sql("op12_collocations", "documents", given))
    assert found.select("lang").distinct().count() >= 3


def test_scores_beyond_64_bits(spark):
    big = 9 * 10**17
    rows = [("en", 0, "", big), ("en", 1, "a", big), ("en", 1, "b", big - 1), ("en", 2, "a b", big - 2), ("en", 1, "c", 40),
            ("en", 2, "b c", 39), ("en", 3, "a b c", 31), ("en", 2, "a a", big - 5), ("en", 3, "a a a", big - 9)]
    frequent = spark.createDataFrame(rows, "lang string, size int, phrase string, n long")
    scored = phrases.scored(frequent)
    by_phrase = {r["phrase"]: r for r in scored.collect()}
    assert by_phrase["a b"]["score"] == 2_000_000 * (big - 2) // (2 * big - 1)
    assert by_phrase["a b c"]["score"] == min(2_000_000 * 31 // (big + 39), 2_000_000 * 31 // (big - 2 + 40))
    # "b c" goes: 100 * 31 < 80 * 39 keeps it, so only "a a" is covered.
    assert sorted(r["phrase"] for r in phrases.without_covered(scored).collect()) == ["a a a", "a b", "a b c", "b c"]


def test_no_phrases(spark):
    empty = spark.createDataFrame([], DOCUMENTS)
    assert phrases.collocations(empty).collect() == []
    assert phrases.collocations(spark.createDataFrame([(1, None, None, 0, "")], DOCUMENTS)).collect() == []


# ---------------------------------------------------------------- clusters

VECTORS = "vec_id long, embedding array<float>, label int, cluster int"


def _brute_clusters(rows, k, rounds, scale=64, size=64, seed=1):
    kept = []
    for key, v, *_ in rows:
        if v is not None and len(v) == size and all(x is not None and np.isfinite(x) for x in v):
            whole = [int(np.floor(max(-(2.0**27), min(2.0**27, scale * float(np.float32(x)))))) for x in v]
            kept.append((key, whole))
    hashed = [(key is None, hashlib.sha256(f"{seed}:{key}".encode()).hexdigest(), v) for key, v in kept]
    centroids = [v for *_, v in sorted(hashed)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), i) for i, c in enumerate(centroids))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for c in range(len(centroids)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == c]
            if mine:
                centroids[c] = [sum(col) // len(mine) for col in zip(*mine, strict=True)]
    last = [(key, *nearest(v)) for key, v in kept]
    return _order((key, c, d) for key, d, c in last), centroids


def _grouped(n, size=64, groups=16, spread=0.3, seed=14):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 4, (groups, size))
    return [(i, (middle[i % groups] + rng.normal(0, spread, size)).astype(np.float32).tolist(), 0, 0) for i in range(n)]


@pytest.mark.parametrize("block_rows", [4096, 7])
def test_clusters(spark, block_rows):
    rows = _grouped(300, groups=5)
    rows += [(500, None, 0, 0), (501, [1.0] * 63, 0, 0), (502, [float("nan")] * 64, 0, 0), (503, [None, *[1.0] * 63], 0, 0), (504, [], 0, 0)]
    rows += [(505, [3e38] * 64, 0, 0), (None, [0.5] * 64, 0, 0), (7, [0.25] * 64, 0, 0), *[(600 + i, [0.125] * 64, 0, 0) for i in range(40)]]
    rows += [(506, [float("inf")] * 64, 0, 0)]
    df = spark.createDataFrame(rows, VECTORS).repartition(4)
    found = clusters.cluster(df, block_rows=block_rows)
    expected, centroids = _brute_clusters(rows, 16, 3)
    assert _found(found.assigned) == expected
    assert found.centroids.tolist() == centroids


def test_only_expired_vectors_are_rescanned(spark):
    """Groups that lie apart: after the first rounds hardly any gap expires, and nothing is missed."""
    rows = _grouped(800, groups=4)
    found = clusters.cluster(spark.createDataFrame(rows, VECTORS), rounds=6, k=4)
    expected, centroids = _brute_clusters(rows, 4, 6)
    assert _found(found.assigned) == expected and found.centroids.tolist() == centroids
    assert found.rescanned[0] == 800 and 0 < sum(found.rescanned[1:]) < 2 * 800
    assert found.rescanned[-1] < 800 // 4


def test_ties_go_to_the_smaller_cluster(spark):
    rows = [(i, [float(i % 2)] * 64, 0, 0) for i in range(40)] + [(100 + i, [0.5] * 64, 0, 0) for i in range(40)]
    found = clusters.cluster(spark.createDataFrame(rows, VECTORS), k=5, rounds=4)
    assert _found(found.assigned) == _brute_clusters(rows, 5, 4)[0]


def test_few_and_no_vectors(spark):
    rows = _grouped(3)
    found = clusters.clusters(spark.createDataFrame(rows, VECTORS))
    assert [(r["distance"], r["inertia"]) for r in found.collect()] == [(0, 0)] * 3
    one = clusters.cluster(spark.createDataFrame(_grouped(50), VECTORS), k=1)
    assert one.assigned.where("cluster = 0").count() == 50 and one.rescanned == [50, 0, 0]
    empty = clusters.clusters(spark.createDataFrame([], VECTORS))
    assert empty.collect() == [] and empty.columns[0] == "vec_id"
    assert clusters.cluster(spark.createDataFrame(rows, VECTORS), rounds=0).assigned.count() == 3


def test_clusters_of_odd_vectors_by_sql(spark):
    rows = _grouped(200, groups=6) + [(900, None, 0, 0), (901, [1.0] * 3, 0, 0), (902, [float("inf")] * 64, 0, 0), (903, [None] * 64, 0, 0)]
    given = spark.createDataFrame(rows, VECTORS)
    assert _found(clusters.clusters(given)) == _order(_sql("op13_centroids", "embeddings", given))


# ---------------------------------------------------------------- language samples


def _sentences(words, n, seed):
    random.seed(seed)
    return [" ".join(random.choices(words, k=12)) + f" {'abcdefghij'[i % 10]}" for i in range(n)]


@pytest.mark.parametrize("doc_id", [3, 10, 20])
def test_a_language_whose_rows_share_one_doc_id_is_learned(spark, doc_id):
    german = _sentences("der die und nicht schön straße über wird mit auch".split(), 3000, 1)
    english = _sentences("the and not with would which their have from this".split(), 3000, 2)
    rows = [(doc_id, t, "de") for t in german] + [(100 + i, t, "en") for i, t in enumerate(english)]
    rows += [(7, "bonjour le monde avec une phrase", "fr")] * 3000
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = langid.fit(df, per_language=200)
    assert sorted(model.langs) == ["de", "en", "fr"]
    asked = spark.createDataFrame([(1, german[5]), (2, english[5]), (3, "bonjour le monde avec une phrase")], "doc_id long, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in langid.predict(asked, model).collect()}
    assert found == {1: "de", 2: "en", 3: "fr"}


def test_more_labels_than_languages(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 6)
    rows = [(k * 100 + i, f"{'abcdefgh'[k] * 5} {'ijklmnop'[k] * (1 + i % 4)}", f"l{k}") for k in range(8) for i in range(20 - k)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df)
    assert sorted(model.langs) == [f"l{k}" for k in range(6)]
    assert langid.predict(df, model).count() == len(rows)


# ---------------------------------------------------------------- URL templates


def _verdicts(spark, rows, rules, **options):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(rows)], "page_id long, url string")
    found = {r["page_id"]: r["verdict"] for r in urls.judge(df, rules=rules, **options).collect()}
    return {u: found[i] for i, u in enumerate(rows)}


@pytest.mark.parametrize("sections", [38, 60, 200])
def test_a_rare_section_is_not_judged_by_the_others(spark, sections):
    """One section's labels are all blocked; however many others are allowed, its other URLs are rejected."""
    rows = [f"http://h.com/s{chr(97 + k // 26)}{chr(97 + k % 26)}/ok/p{chr(97 + j)}" for k in range(sections) for j in range(26)]
    rows += [f"http://h.com/bad/ok/p{chr(97 + j)}" for j in range(16)] + [f"http://h.com/bad/other/q{chr(97 + j)}" for j in range(4)]
    rules = tuple(urls.Rule("allow", "h.com", f"/s{chr(97 + k // 26)}{chr(97 + k % 26)}/ok") for k in range(sections))
    found = _verdicts(spark, rows, (*rules, urls.Rule("block", "h.com", "/bad/ok")))
    assert {v for u, v in found.items() if "/bad/" in u} == {"block"}
    assert {v for u, v in found.items() if "/bad/" not in u} == {"allow"}


@pytest.mark.parametrize("level", [2, 6, 9])
def test_a_blocked_branch_at_any_level(spark, level):
    above = "/".join("abcdefghij"[: level - 1])
    rows = [f"http://h.com/{above}/good/x{chr(97 + j)}/{t}" for j in range(20) for t in ("seen", "new")]
    rows += [f"http://h.com/{above}/bad/x{chr(97 + j)}/{t}" for j in range(20) for t in ("seen", "new")]
    rules = tuple(urls.Rule(v, "h.com", f"/{above}/{b}/x{chr(97 + j)}/seen") for v, b in (("block", "bad"), ("allow", "good")) for j in range(20))
    found = _verdicts(spark, rows, rules)
    assert {v for u, v in found.items() if "/bad/" in u} == {"block"}
    assert {v for u, v in found.items() if "/good/" in u} == {"allow"}
