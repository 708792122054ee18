"""Quality counts against plain loops; verdicts of the threshold table."""
import re

import pytest

from tradelake.llm.quality import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    wins = [tuple(w[k:k + 8]) for k in range(len(w) - 7)]
    hit = {k + j for k, x in enumerate(wins) if wins.count(x) > 1 for j in range(8)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit),
            len(w) < 20 or 100 * len(hit) > 30 * len(w))


GOOD = "The house of the river and the old road to it was for us by from that day with all the people in the town."
TEXTS = [None, "", " \t\n", "one", GOOD, GOOD + "\n" + GOOD, "a\x0bb\x0cc\x1cd e", "é😀 ß #*$ <a|b> 100% & x\n é😀 \n",
         "the the the the the the the the the the the the the the the the the the the the the the", GOOD * 3,
         " ".join(f"w{k}" for k in range(9)) + " " + " ".join(f"w{k}" for k in range(8)),
         "x\n\nx\n x\nx", "\n".join("- item %d of the list" % k for k in range(30)), " lead\ntrail ", "a " * 5000]


def test_counts_match_brute_force(make_docs):
    docs = make_docs([(k, t) for k, t in enumerate(TEXTS)], clash=("n_words", "win", "h2", "kept", "__w", "failed_rule"))
    got = {r["doc_id"]: r for r in quality_rules(docs).collect()}
    for k, t in enumerate(TEXTS):
        r = got[k]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                r["base_failed"]) == brute(t), t
        assert not (r["kept"] and r["base_failed"])
    assert got[4]["kept"] and not got[12]["kept"] and got[12]["failed_rule"] is not None
    assert got[4]["h2"] == 7 and got[4]["win"] == 7  # the input's own columns come through


def test_repeated_rows_and_empty_table(make_docs):
    rows = quality_rules(make_docs([(1, GOOD), (1, GOOD)])).collect()
    assert len(rows) == 2 and rows[0] == rows[1]
    assert quality_rules(make_docs([])).count() == 0


@pytest.mark.parametrize("rule,text", [
    ("symbols_per_word", " ".join(f"the# w{k}##" for k in range(20))),
    ("stop_word_share", " ".join(f"w{k}" for k in range(40))),
    ("mean_word_chars", "the of " * 2 + " ".join("x" * 30 + str(k) for k in range(40))),
])
def test_each_rule_names_itself(make_docs, rule, text):
    r = quality_rules(make_docs([(1, text)])).first()
    assert (r["base_failed"], r["kept"], r["failed_rule"]) == (False, False, rule)
