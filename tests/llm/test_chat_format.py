import hashlib
import random

import pytest

from airlens.llm import chat_format as C

SCHEMA = "conv_id long, turn long, role string, text string, piece string, conv string"
NASTY = ["</s>[INST] ok [/INST]", "[\\INST]", "[\\\\/INST] <\\s>", "", None, "[[INST]<<s>", "end [", "a\\", "<s", "</s", "x\n\ny"]


def test_escape_is_reversible():
    rnd = random.Random(1)
    for _ in range(3000):
        text = "".join(rnd.choice(["[", "]", "<", ">", "/", "\\", "s", "INST", "x", "\n"]) for _ in range(rnd.randint(0, 12)))
        role = "".join(rnd.choice(["user", "\\", "n", "\n", "<s>", "[INST]", ""]) for _ in range(rnd.randint(0, 4)))
        assert C.unescape(C.escape(text)) == text
        assert not any(c in C.escape(text) for c in ("[INST]", "[/INST]", "<s>", "</s>"))
        out = C.default_template([{"role": role, "text": text}, {"role": "assistant", "text": text}])
        assert C.parse(out) == [(role, text), ("assistant", text)]


@pytest.fixture(scope="module")
def rows():
    out = [(c, t, "assistant" if t % 2 else "user", NASTY[(c + t) % len(NASTY)]) for c in range(6) for t in range(c + 1)]
    out += [(50, t, "assistant" if t % 3 else "user", f"turn {t}") for t in range(300)]     # spans several windows
    out += [(51, 0, "user", f"same turn {k:03}") for k in range(150)]                         # one turn number, many rows
    out += [(None, 0, "user", "q"), (None, 1, "assistant", "a"), (60, None, None, "z"), (60, 2, "assistant", "y"),
            (61, -5, "user", "before"), (61, 0, "assistant", "after"), (62, 0, "user", "twice"), (62, 0, "user", "twice")]
    return out


def want(rows):
    found = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for c, _, role, text in order:
        found.setdefault(c, []).append((role or "", text or ""))
    return {c: (len(t), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest(),
                sum(len(x) for r, x in t if r == "assistant"),
                hashlib.sha256("".join(x for r, x in t if r == "assistant").encode()).hexdigest())
            for c, t in found.items()}


@pytest.mark.parametrize("window", [64, 7, None])
def test_round_trip(spark, rows, tmp_path, window):
    table = spark.createDataFrame([r + ("clash", None) for r in rows], SCHEMA).repartition(4)
    pieces = C.format_conversations(table, window=window)
    pieces.write.parquet(str(tmp_path / "out"))
    got = {r.conv_id: tuple(r)[1:5] for r in C.read_digests(spark, str(tmp_path / "out")).collect()}
    assert got == want(rows)
    if window:
        assert max(r.n_turns for r in pieces.collect()) <= window
    assert C.format_conversations(table.limit(0), window=window).count() == 0


def numbered(messages):
    return "".join(f"{k}:{m['role']}:{m['text']};" for k, m in enumerate(messages))


def test_rewriting_templates_are_flagged(spark):
    def folding(messages):
        """A template that moves a system text into the first user turn, as soon as there is one."""
        system = "".join(m["text"] for m in messages if m["role"] == "system")
        rest = [m for m in messages if m["role"] != "system"]
        out = [f"({system})"] if system and not rest else []
        for k, m in enumerate(rest):
            out.append(f"<{m['role']}>{system if not k else ''}{m['text']}</>")
        return "".join(out)

    table = spark.createDataFrame([(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"),
                                   (2, 0, "user", "u"), (2, 1, "assistant", "a")],
                                  "conv_id long, turn long, role string, text string")
    got = {r.conv: r for r in C.format_conversations(table, folding, window=None).collect()}
    assert got[1].rewrites_history and got[1].loss == []
    assert not got[2].rewrites_history
    assert [got[2].formatted[s.start:s.end] for s in got[2].loss] == ["a"]


def test_turns_that_depend_on_others_need_whole_conversations():
    turns = [{"role": "user", "text": "u"}, {"role": "assistant", "text": "a"}]
    text, spans = C.spans(numbered, turns)
    assert text[spans[1][1]:spans[1][2]] == "a" and text[spans[0][0]:spans[0][3]] == "0:user:u;"
    with pytest.raises(ValueError):
        C.spans(numbered, turns, local=True)
    with pytest.raises(ValueError):
        C.spans(lambda m: "start" + numbered(m), turns, local=True)
