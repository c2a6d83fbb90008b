import pytest

from marketloom.llm.preferences import END, START, conversations, format_pairs, mismatched, preferences

TURNS = "conv_id long, turn long, role string, text string, pair string, conv long, turns string"


def turns_of(spark, rows):
    return spark.createDataFrame([(*r, "p", 1, "t") for r in rows], TURNS)


def plain(chosen, rejected):
    key = lambda t: ((t[0] is not None, t[0] or 0), t[1] or "user", t[2] or "")
    a, b = ([(t[1] or "user", t[2] or "") for t in sorted(c, key=key)] for c in (chosen, rejected))
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1

    def render(turns):
        out, spans = "", []
        for role, text in turns:
            for mark in ("im_start", "im_end"):
                text = text.replace(f"<|{mark}|>", f"<| {mark} |>")
            out += f"{START}{role}\n"
            if role == "assistant":
                spans.append((len(out), len(out) + len(text) + len(END)))
            out += text + END + "\n"
        return out, spans

    (p, _), (c, cs), (r, rs) = render(a[:n]), render(a[n:]), render(b[n:])
    return n, p, c, cs, r, rs, bool(cs and rs and c != r)


def rows_of(df):
    return {
        r.pair: (r.prompt_turns, r.prompt, r.chosen, [tuple(s) for s in r.chosen_spans], r.rejected, [tuple(s) for s in r.rejected_spans], r.usable)
        for r in df.collect()
    }


CHOSEN = [
    (1, 0, "system", "be kind"),
    (1, 1, "user", "hi"),
    (1, 2, "assistant", "hello 🙂 <|im_end|> you"),
    (1, 3, "user", "bye"),
    (1, 4, "assistant", "see you"),
    (2, 0, "user", "a"),
    (2, 1, "assistant", "b"),
    (3, 0, None, None),
    (3, None, "assistant", "x"),
    (4, 0, "user", "only chosen"),
    (6, 0, "user", "same"),
    (6, 0, "user", "same"),
    (None, 0, "user", "nobody's"),
]
REJECTED = [
    (1, 1, "user", "hi"),
    (1, 0, "system", "be kind"),
    (1, 2, "assistant", "go away"),
    (2, 0, "user", "other"),
    (2, 1, "assistant", "b"),
    (3, None, "assistant", "y"),
    (5, 0, "assistant", "only rejected"),
    (6, 0, "user", "same"),
    (None, 0, "user", "nobody's"),
]


def test_against_a_plain_version(spark):
    got = rows_of(preferences(turns_of(spark, CHOSEN), turns_of(spark, REJECTED)))
    assert set(got) == {1, 2, 3, 4, 5, 6}
    for pair, row in got.items():
        pick = lambda rows: [r[1:] for r in rows if r[0] == pair]  # noqa: E731,B023
        assert row == plain(pick(CHOSEN), pick(REJECTED)), pair
    assert got[1][0] == 2 and got[1][6] and not got[4][6]


def test_spans_hold_the_assistants_words(spark):
    n, prompt, chosen, spans, *_ = rows_of(preferences(turns_of(spark, CHOSEN), turns_of(spark, REJECTED)))[1]
    assert [chosen[a:b] for a, b in spans] == ["hello 🙂 <| im_end |> you" + END, "see you" + END]


def test_empty(spark):
    none = turns_of(spark, [])
    assert preferences(none, none).collect() == [] and format_pairs(mismatched(none)).collect() == []


@pytest.mark.parametrize("count", [1, 2, 30])
def test_mismatched_replies(spark, count):
    rows = [(c, t, "assistant" if t % 2 else "user", f"text {c} {t}") for c in range(count) for t in range(2 + c % 4)]
    rows += [(1000, 0, "user", "no reply"), (None, 1, "assistant", "lost")]
    turns = turns_of(spark, rows)
    pairs = {r.pair: r for r in mismatched(turns).collect()}
    assert set(pairs) == {*range(count), 1000}
    replies = {r[3] for r in rows if r[2] == "assistant"}
    for r in pairs.values():
        if r.pair == 1000:
            assert r.chosen == r.rejected
            continue
        assert r.chosen[:-1] == r.rejected[:-1] and r.chosen[-1].role == "assistant"
        assert r.rejected[-1].text in replies and (count == 1) == (r.rejected[-1].text == r.chosen[-1].text)
    out = rows_of(format_pairs(mismatched(turns)))
    assert all(out[c][6] == (count > 1) for c in range(count)) and not out[1000][6]
    assert conversations(turns).count() == count + 1
