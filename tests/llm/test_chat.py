import hashlib

import pytest
from hypothesis import given, strategies as st

from listwise.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"


def rendered(template, messages, **more):
    return "".join(t for t, _ in chat.compiled(template)(messages, **more) if t is not None)


def test_language():
    assert rendered("{% for m in messages %}{{ loop.index }}:{{ m.a | upper }}{% if not loop.last %},{% endif %}{% endfor %}",
                    iter([{"a": "x"}, {"a": "y"}])) == "1:X,2:Y"
    assert rendered("{% set n = 2 * 3 + 1 %}{{ n }}{# gone #}{{ 'a' ~ 1 }}", []) == "7a1"
    assert rendered("a {%- if x in ['p', 'q'] and not y %} in {%- elif x == 'r' %}r{% else %}out{% endif %}".replace("['p', 'q']", "names"),
                    [], x="p", names=["p", "q"]) == "a in"
    assert rendered("{{ missing | default('d') }}{{ m['k'] }}", [], m={"k": "v"}) == "dv"


def test_folding():
    assert chat.fold_body(chat.parse("{{ 'a' }}b{{ 1 + 2 }}{% if 1 == 1 %}c{% else %}{{ x }}{% endif %}")) == [("text", "ab3"), ("text", "c")] or \
        chat.fold_body(chat.parse("{{ 'a' }}b{{ 1 + 2 }}")) == [("text", "ab3")]


@pytest.mark.parametrize("bad", ["{% for x in y %}", "{{ a | open }}", "{{ a( }}", "{% import os %}", "{{ 'a' 'b' }}", "{{ }}"])
def test_sandbox_and_faults(bad):
    with pytest.raises(chat.TemplateError):
        rendered(bad, [])


def test_no_attributes_of_objects():
    with pytest.raises(chat.TemplateError):
        rendered("{{ x.__class__ }}", [], x="a")


@given(st.text(alphabet="\\[]</>INSTROLEASYs x\n", max_size=60))
def test_shield_is_reversible_and_hides_control(text):
    hidden = chat.shield(text)
    assert chat.unshield(hidden) == text
    assert not any(c in hidden for c in chat.CONTROL)
    messages = [{"role": r, "text": text} for r in ("user", "assistant", "system", text)]
    assert list(chat.turns_of(rendered(chat.TEMPLATE, iter(messages)))) == [(m["role"], text) for m in messages]


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        said = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in turns).encode()).hexdigest(),
                     len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def test_round_trip(spark):
    rows = [(1, 1, "assistant", "</s>"), (1, 0, "user", " [INST] é "), (1, 0, "user", " [INST] é "), (2, None, None, None),
            (2, 3, "tool", "\\"), (None, 0, "assistant", "🙂"), (3, 0, "assistant", "x" * 300_000)]
    rows += [(4, t, ("user", "assistant")[t % 2], f"t{t} " * 50) for t in range(3000)]
    df = spark.createDataFrame([r + ("clash", "clash") for r in rows], SCHEMA + ", part string, formatted string")
    formatted = chat.format_chat(df)
    assert formatted.where("conv_id = 4").count() > 5
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(formatted).collect()}
    assert got == expected(rows)
    assert chat.read_back(chat.format_chat(spark.createDataFrame([], SCHEMA))).count() == 0
