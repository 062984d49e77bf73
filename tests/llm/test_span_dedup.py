import random

from pyspark.sql import Row

from tapewright.llm.span_dedup import MIN_WORDS, remove_repeats, removed_sentences, sentences


def plain(piece: str) -> tuple:
    return tuple(piece.lower().split())


def brute(texts: dict, least: int = MIN_WORDS) -> dict:
    """Every run of two sentences or more with enough words, compared as words; a shorter text is one run."""
    first: dict = {}
    out = {}
    for i in sorted(texts, key=lambda k: (k is None, k)):
        pieces = sentences(texts[i])
        gone, seen = set(), set()
        words = [plain(p) for p in pieces]
        places = [(a, b) for a in range(len(words)) for b in range(a + 2, len(words) + 1) if sum(map(len, words[a:b])) >= least]
        if not places and any(words):
            places = [(0, len(words))]
        for a, b in places:
            run = tuple(words[a:b])
            if first.setdefault(run, i) != i or run in seen:
                gone |= set(range(a, b))
            seen.add(run)
        out[i] = sorted(gone)
    return out


def got(docs) -> dict:
    return {r["row"]["doc_id"]: list(r["removed"]) for r in removed_sentences(docs).collect()}


def test_sentences_make_up_the_text():
    rng = random.Random(3)
    alphabet = ["a", "word", "Comma,", " ", "  ", "\n", "\n\n", ".", "...", "! ", "?", "3.5", '."', ". ", "\t", "\u00a0", ""]
    for _ in range(3000):
        text = "".join(rng.choices(alphabet, k=rng.randrange(60)))
        assert "".join(sentences(text)) == text
    assert sentences(None) == [] and sentences("") == []
    assert sentences("Pi is 3.14 or so. Yes.\nNo") == ["Pi is 3.14 or so. ", "Yes.\n", "No"]
    long = " ".join(f"w{k}" for k in range(1000))
    assert max(len(p.split()) for p in sentences(long)) <= 48 and min(len(p.split()) for p in sentences(long)[:-1]) >= 12
    # cut alike wherever it stands
    assert set(sentences("x y z " + long)[3:-3]) <= set(sentences(long))


def test_very_long_texts_take_linear_time():
    for text in ("." * 400_000, " " * 400_000, "a" * 400_000, "\n" * 400_000, ". " * 200_000, "?" * 200_000 + "x" * 200_000, "w " * 200_000):
        assert "".join(sentences(text)) == text


def test_repeats_go_but_for_the_first(spark):
    passage = "".join(f"Sentence number {i} of the shared passage here. " for i in range(6))
    own = {i: "".join(f"Document {i} says thing {j} of its own. " for j in range(5)) for i in range(8)}
    texts = {i: own[i] + (passage.upper() if i == 3 else passage if i % 2 else "") + own[i][:40] for i in own}
    texts[9], texts[10], texts[11], texts[12] = None, "", own[0], "Short. Short. Short."
    texts[13] = passage + "New end. " + passage
    docs = spark.createDataFrame([Row(doc_id=i, text=t, run="clash", removed=1) for i, t in texts.items()])
    assert got(docs) == brute(texts)
    left = remove_repeats(docs)
    kept = {r["doc_id"]: r["text"] for r in left.collect()}
    assert left.columns == docs.columns and 11 not in kept and kept[1] == texts[1] and "shared" not in kept[3].lower()
    assert kept[13] == "New end. " and kept[9] is None


def test_odd_rows(spark):
    text = "One two three four five. Six seven eight nine. Ten eleven twelve thirteen."
    docs = spark.createDataFrame([Row(doc_id=1, text=text), Row(doc_id=1, text=text), Row(doc_id=None, text=text)], "doc_id long, text string")
    found = [(r["row"]["doc_id"], len(r["removed"])) for r in removed_sentences(docs).collect()]
    assert sorted(found, key=str) == [(1, 0), (1, 0), (None, 3)]
    assert removed_sentences(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, "t", 2)], "doc_id long, text string, `a.b``c` int")
    assert [tuple(r) for r in remove_repeats(odd).collect()] == [(1, "t", 2)]
    alone = spark.createDataFrame([("Word. " * 30_000,)], "text string").selectExpr("1L doc_id", "text")
    assert len(remove_repeats(alone).first()["text"].split()) == 1


def words(tag: str, n: int) -> str:
    return " ".join(f"{tag}{k}" for k in range(n))


def test_passages_go_however_they_are_set(spark):
    one = words("single", 55).capitalize() + ". "
    two = words("left", 30).capitalize() + ". " + words("right", 28).capitalize() + ". "
    # the first and last sentence of the passage run into the host text
    merged = words("start", 20) + ". Inner " + words("inner", 8) + ". More " + words("more", 8) + ". Ending " + words("ending", 20)
    texts = {}
    for k in range(2):
        own = words(f"host{k}x", 9).capitalize() + ". "
        texts[2 * k] = own + one + own.upper().replace("HOST", "B") + two + words(f"after{k}y", 9) + "."
        texts[2 * k + 1] = words(f"other{k}z", 5) + " " + merged + " " + words(f"tail{k}w", 5) + "."
    docs = spark.createDataFrame([Row(doc_id=k, text=t) for k, t in texts.items()])
    left = {r["doc_id"]: r["text"] for r in remove_repeats(docs).collect()}
    assert left[0] == texts[0] and left[1] == texts[1]
    assert "single" not in left[2].lower() and "left" not in left[2].lower() and "right" not in left[2].lower()
    assert "inner" not in left[3].lower() and "more" not in left[3].lower() and "tail1w4" in left[3]
    assert "host1x" in left[2].lower() and "after1y8" in left[2]


def test_lines_that_many_documents_share_stay(spark):
    line = "This work may be copied by anyone for any purpose at all. "
    texts = {k: words(f"a{k}x", 9) + ". " + line + words(f"b{k}x", 9) + "." for k in range(30)}
    docs = spark.createDataFrame([Row(doc_id=k, text=t) for k, t in texts.items()])
    assert not any(got(docs).values())


def test_hashed_runs_cover_what_all_runs_cover(spark):
    rng = random.Random(5)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.randrange(1, 16))) + ". " for _ in range(14)]
    texts = {k: "".join(rng.choices(pool, k=rng.randrange(14))) for k in range(150)}
    docs = spark.createDataFrame([Row(doc_id=k, text=t) for k, t in texts.items()])
    wanted = brute(texts)
    assert got(docs) == wanted and any(wanted.values()) and not all(wanted.values())


def test_short_passages_of_several_sentences_go(spark):
    three = "".join(words(f"p{k}q", 6).capitalize() + ". " for k in range(3))
    two = "".join(words(f"r{k}s", 11).capitalize() + ". " for k in range(2))
    texts = {k: words(f"a{k}x", 9) + ". " + (three if k < 2 else two) + words(f"b{k}x", 9) + "." for k in range(4)}
    docs = spark.createDataFrame([Row(doc_id=k, text=t) for k, t in texts.items()])
    assert got(docs) == {0: [], 1: [1, 2, 3], 2: [], 3: [1, 2]}
