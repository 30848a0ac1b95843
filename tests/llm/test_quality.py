import random
import re

import regex

from tallyline.llm import quality
from tests.llm.helpers import COLUMNS, WORD, documents, lower

ENDS = regex.compile(r"[.!?:;\"'…。！？；：｡।॥؟۔؛։።᙮\p{Pe}\p{Pf}\p{Pi}]$")


def plain(text):
    """The counts of one text, and the text that stays, word by word and line by line."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    covered = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    seen, dup, lost, kept = set(), 0, 0, []
    for line in text.split("\n"):
        own = WORD.findall(line)
        if not own:
            continue
        fails = line in seen or not ENDS.search(own[-1])
        dup += line in seen
        seen.add(line)
        fails |= sum(w in quality.SEPARATORS for w in own) > 0.2 * len(own)
        fails |= len(re.findall(r"[#*$%&|<>]", line)) > 0.3 * len(own)
        phrases = [p.decode() for p in quality.BOILERPLATE]
        fails |= any(p in lower(line) and len(p.split()) >= 0.25 * len(own) for p in phrases)
        if fails:
            lost += sum(map(len, own))
        else:
            kept.append(line)
    chars = sum(map(len, words))
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    counts = (len(words), chars, len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), lost)
    return (*counts, failed, not failed and lost <= 0.5 * chars), kept


def texts(n=200, seed=8):
    rng = random.Random(seed)
    lines = ["Menu | Home | About |", "All rights reserved.", "Please enable JavaScript!", "é è ç.", " \t", "", "# $ % done."]
    lines += ["Tous droits réservés.", "Il a lu la politique de confidentialité et les conditions avant de signer.", "„So.“", "sagte er ‘so’", "क ख।", "؟ نعم؟", "a ］", "b⸥", "c†", "𝄞"]
    out = []
    for _ in range(n):
        own = []
        for _ in range(rng.randrange(12)):
            words = [f"{rng.choice('abcdéü')}{rng.randrange(40)}" for _ in range(rng.randrange(12))]
            own.append(" ".join(words) + rng.choice([".", ".", "", "…", "»", "\r"]))
        own += rng.choices(lines, k=rng.randrange(3)) + own[: rng.randrange(3)]
        rng.shuffle(own)
        out.append("\n".join(own))
    return [None, "", "\n\n", "a b c a b c", "x " * 100_000, *out]


def test_counts_verdicts_and_kept_lines(spark):
    docs = texts()
    df = documents(spark, docs)
    rated = quality.rate(df, with_text=True)
    rows = rated.collect()
    assert len(rows) == len(docs)
    for r in rows:
        counts, kept = plain(docs[r.doc_id]) if r.doc_id != 4 else ((100_000, 100_000, 0, 0, 100_000, 100_000, True, False), [])
        assert (*(r[c] for c in quality.ADDED), r.base_failed, r.kept) == counts, docs[r.doc_id]
        if r.lost_chars:
            assert r.kept_text == "\n".join(kept)
        else:
            assert r.kept_text == docs[r.doc_id]
    assert [c for c in df.columns if c not in (*quality.ADDED, "kept")] == rated.columns[: len(df.columns) - 2]


def test_clean_prose_is_kept_and_menus_are_rejected(spark):
    prose = "\n".join(" ".join(f"w{k * n}" for n in range(1, 12)) + "." for k in range(10, 30))
    menu = "\n".join(f"Home {k} | News {k} | Sport {k} | Weather {k} |" for k in range(20))
    rows = quality.rate(documents(spark, [prose, menu, prose + "\n" + "Next page"])).orderBy("doc_id").collect()
    assert [r.kept for r in rows] == [True, False, True]


def test_dialogue_and_sentences_about_policies_are_kept(spark):
    names = ["Anna", "Ben", "Clara", "David", "Emma", "Felix", "Greta", "Hans", "Ida", "Jan"]
    dialogue = "\n".join(f"„{n} kam heute an und blieb bis zum Abend bei uns, sagte {n}so.“" for n in names)
    news = "\n".join(
        f"The regulator told company {n} that its privacy policy and terms of use misled {n} readers for years." for n in names
    )
    footer = "\n".join(f"Company {n} privacy policy" for n in range(60))
    docs = documents(spark, [dialogue, news, footer])
    lost = [r.lost_chars / r.word_chars for r in quality.rate(docs).orderBy("doc_id").collect()]
    assert lost == [0, 0, 1]
    rows = quality.rate(docs, phrases=(b"kam heute an und blieb",)).orderBy("doc_id").collect()
    assert [r.lost_chars / r.word_chars for r in rows] == [1, 0, 1]


def test_texts_without_words_only(spark):
    for docs in ([None], [""], [None, "", " \n\n "], ["\n"]):
        rows = quality.rate(documents(spark, docs).coalesce(1), with_text=True).collect()
        assert all((r.n_words, r.base_failed, r.kept, r.kept_text) == (0, True, False, docs[r.doc_id]) for r in rows)


def test_empty_table(spark):
    assert quality.rate(spark.createDataFrame([], COLUMNS)).collect() == []
