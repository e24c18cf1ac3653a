import re
from collections import Counter

from recordloom.llm.common import take
from recordloom.llm.line_rules import LineRules, clean_text, line_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    wins = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    c = Counter(wins)
    hit = {j for i, x in enumerate(wins) if c[x] > 1 for j in (i, i + 1, i + 2)}
    lines = t.split("\n")
    dup = sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines))
    return len(w), sum(map(len, w)), sum(ch in "#*$%&|<>" for ch in t), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


def test_measures_and_edges(spark, make, prose):
    texts = [None, "", "  \n\t", "a b c a b c a", "x\x0by z é#%\n|a|\n|a|\na", prose(80, 1), prose(80, 1), prose(20000, 2), "same line here.\n" * 60, "\x1c   w"]
    docs = make(list(enumerate(texts)) + [(None, prose(60, 3)), (5, texts[5])])
    r = line_rules(docs, result="out")
    assert r.columns == [*docs.columns, "out"]
    rows = take(r, "doc_id", "text", "out").collect()
    assert len(rows) == docs.count()
    for x in rows:
        assert tuple(x.out)[:6] == brute(x.text), x.doc_id
        assert x.out.kept <= (not x.out.base_failed)
    by = {x.doc_id: x.out for x in rows}
    assert by[5].kept and by[7].kept and by[None].kept and not by[0].kept and by[0].clean is None and by[1].clean == ""
    assert line_rules(docs.limit(0)).count() == 0


def test_lines_are_judged_first(prose):
    good = prose(90, 4)
    text = f"Home | About | Contact | Login\n{good}\nThis site uses cookies.\nBUY!! NOW!! HERE!!\n\nno mark"
    clean, n = clean_text(text, LineRules())
    assert clean == good + "\n" and n == 90


def test_too_much_loss(make, prose):
    docs = make([(1, prose(60, 5) + "\n" + " | ".join(prose(200, 6).split())), (2, prose(200, 7) + "\n" + " | ".join(prose(30, 8).split()))], extra=False)
    got = {r.doc_id: r.rules.kept for r in line_rules(docs).collect()}
    assert got == {1: False, 2: True}
