import re
import zlib

from hypothesis import given, settings, strategies as st

from listwise.llm import pii


def plain(text):
    """The base kinds by the plain expressions."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m.group())
        double = sum(sum(divmod(2 * int(c), 10)) if i % 2 else int(c) for i, c in enumerate(d[::-1]))
        if 14 <= len(d) <= 19 and double % 10 == 0:
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted((s, pii.KINDS.index(k), k, e) for k, s, e in out)


def base(text):
    return sorted((s["start"], pii.KINDS.index(s["kind"]), s["kind"], s["end"]) for s in pii.spans_of(text) if s["kind"] in pii.BASE)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["a", "a.b", "@", ".", "x-y.org", "1", "25", "256", "010", "192.168.0.1", "+1", " ", "-", "(555)", "é", "42424242424242",
                                 "4242 4242 4242 4242", "+1 (555) 010-9999", "m@h.io", "\n", "_"]), max_size=14))
def test_base_kinds(parts):
    text = "".join(parts)
    assert base(text) == plain(text)


def test_checks_and_context():
    good = "GB82 WEST 1234 5698 7654 32"
    assert [s["kind"] for s in pii.spans_of(f"IBAN {good}.")] == ["iban"]
    assert pii.spans_of("GB83 WEST 1234 5698 7654 32") == []
    near = pii.spans_of("please call +15550109999")[0]["score"]
    assert near > pii.spans_of("+15550109999")[0]["score"] > pii.spans_of("version +15550109999")[0]["score"]
    assert pii.luhn("4242424242424242") and not pii.luhn("4242424242424241")


def ibans(text):
    return [text[s["start"]:s["end"]] for s in pii.spans_of(text) if s["kind"] == "iban"]


def test_iban_before_other_tokens():
    good = ["ES91 2100 0418 4502 0005 1332", "AT611904300234573201", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"]
    for iban in good:
        for after in ("", ".", " BIC: X", " 12 items", " X", " AB12 CD34 EF56 GH78", " A1 and", " SWIFT", "\n12", " 1 2 3"):
            assert ibans(f"IBAN {iban}{after}") == [iban], (iban, after)
        assert ibans(f"{iban}x") == ibans(f"x{iban}") == ibans(iban + "7") == []
    assert ibans(" ".join(good)) == good
    assert ibans("ES92 2100 0418 4502 0005 1332 BIC: X") == []


def test_context_rejects_an_added_span():
    iban = "AT611904300234573201"
    assert ibans(f"serial {iban}") == ibans(f"{iban} is a hash") == []
    assert ibans(iban) == ibans(f"serial or bank account {iban}") == [iban]


def test_long_runs_take_linear_time():
    pii.spans_of("a" * 300_000 + " " + "1" * 300_000 + " " + "+1" + "." * 300_000)


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "a@b.co", "x"), (2, "", "x"), (3, "🙂 a@b.co", "x"), (3, "🙂 a@b.co", "x")],
                               "doc_id long, text string, spans string")
    got = sorted(((r.doc_id or 0, [(s.start, s.end) for s in r.spans]) for r in pii.find_pii(df).collect()))
    assert got == [(0, [(0, 6)]), (1, []), (2, []), (3, [(2, 8)]), (3, [(2, 8)])]
    assert pii.find_pii(df.limit(0)).count() == 0


def kinds(text):
    return [(s["kind"], text[s["start"]:s["end"]]) for s in pii.spans_of(text) if s["kind"] not in pii.BASE]


def test_secrets_need_context_or_a_checksum():
    run = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    assert kinds(f'the token = "{run}" stays') == [("secret", run)] == kinds(f"Authorization: Bearer {run}")
    assert kinds(run) == kinds(f"sha digest {run}") == kinds(f"the key has the hash {run}") == kinds("key: aaaaaaaaaaaaaaaaaaaaaaaa1") == kinds("secret abcdefghijklmnopqrstuvwxyz") == []
    body = "abcDEF0123456789ghijKLMNOPqrst"
    n, tail = zlib.crc32(body.encode()), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        tail = pii._BASE62[d] + tail
    assert kinds(f"commit ghp_{body}{tail}") == [("secret", f"ghp_{body}{tail}")]
    assert kinds(f"commit ghp_{body}{tail[:-1]}{'0' if tail[-1] != '0' else '1'}") == []


def test_routing_numbers():
    assert kinds("routing number 021000021") == [("routing", "021000021")] == kinds("ABA: 021000021.")
    assert kinds("021000021") == kinds("routing 021000022") == kinds("routing 991000021") == kinds("order 021000021 by wire serial") == []
