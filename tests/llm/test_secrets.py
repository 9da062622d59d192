import base64
import hashlib
import re
import time

from helpers_llm import SMOKE, odd_docs
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkmarts.llm.common import table
from sparkmarts.llm.queries import op8_secrets
from sparkmarts.llm.secret_scan import KINDS, _crc62, byte_spans, code_points, keyword_automaton, redact, secrets

NAME = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
ASSIGN = re.compile(rf"""({NAME})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def brute(text):
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def found(text, base=True):
    data = text.encode()
    got = code_points(data, byte_spans(keyword_automaton(), data))
    return [s for s in got if not base or s[0] in ("assign", "access", "hex")]


PIECES = ["password", "Passwd", "SECRET", "token", "api_key", "APIkey", "AKIA", "ABCDEFGH12", "=", ":", " ", '"', "'", "é", "ſecret", "toKen", "0123456789abcdef", "deadbeefdeadbeefdeadbeef", "x", "\n", "a.b", "ſ", "Key", "api", "_"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=24).map("".join))
def test_base_kinds_against_plain_expressions(text):
    assert found(text) == brute(text)


def test_checksums():
    body = b"0123456789abcdefghijklmnopqrst"
    good = (b"ghp_" + body + _crc62(body)).decode()
    assert ("github", 3, 43) in found(f"é: {good}", base=False)
    assert not found(good[:-1] + ("0" if good[-1] != "0" else "1"), base=False)
    part = lambda s: base64.urlsafe_b64encode(s).rstrip(b"=").decode()
    jwt = f"{part(b'{\"alg\":\"HS256\"}')}.{part(b'{\"sub\":1}')}.sig"
    assert ("jwt", 0, len(jwt)) in found(jwt, base=False)
    assert not found(f"{part(b'{\"typ\":1}')}.{part(b'{\"sub\":1}')}.x", base=False)
    pem = lambda der: f"-----BEGIN PRIVATE KEY-----\n{base64.b64encode(der).decode()}\n-----END PRIVATE KEY-----"
    assert [k for k, *_ in found(pem(b"\x30\x03abc"), base=False)] == ["pem"]
    assert not found(pem(b"\x30\x04abc"), base=False)
    assert ("card", 6, 25) in found("card: 4111 1111 1111 1111", base=False)
    assert not found("card: 4111 1111 1111 1112", base=False)


def test_openssh_and_encrypted_keys():
    def block(label, data, headers="", end="\n"):
        body = base64.encodebytes(data).decode()
        return f"-----BEGIN {label} PRIVATE KEY-----\n{headers}{body}-----END {label} PRIVATE KEY-----".replace("\n", end)

    field = lambda x: len(x).to_bytes(4, "big") + x
    one = b"\0\0\0\1" + field(b"p" * 51) + field(b"k" * 144)
    key = b"openssh-key-v1\0" + field(b"none") + field(b"none") + field(b"") + one
    for end in ("\n", "\r\n"):
        text = block("OPENSSH", key, end=end)
        assert ("pem", 2, 2 + len(text)) in found(f"x {text} y", base=False)
        headers = "Proc-Type: 4,ENCRYPTED\nDEK-Info: AES-128-CBC,00112233445566778899AABBCCDDEEFF\n\n"
        text = block("RSA", b"\x81" * 608, headers, end)
        assert ("pem", 0, len(text)) in found(text, base=False)
    kinds = lambda text: [k for k, *_ in found(text, base=False)]
    assert kinds(block("RSA", b"\x30\x03abc", "Comment: c\n\n")) == ["pem"]
    for bad in (key[:-1], key[:40], key + b"x", key[1:], b"openssh-key-v1\0"):
        assert "pem" not in kinds(block("OPENSSH", bad))
    assert "pem" not in kinds(block("RSA", b"\x81" * 607, headers))


def test_query_on_given_tables(spark):
    texts = {r.doc_id: r.text or "" for r in table(spark, SMOKE, "documents").collect()}
    for r in op8_secrets(spark, SMOKE).collect():
        want = brute(texts[r.doc_id])
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[0] == k for s in want) for k in ("assign", "access", "hex")]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert set(filter(None, text.split(","))) <= set(r.spans.split(","))


def test_redaction_and_odd_rows(spark):
    docs = odd_docs(spark)
    assert secrets(docs, spans_col="found").count() == docs.count()
    assert redact(docs).collect() == docs.collect()
    rows = [(1, 'é token = "0123456789abcdef0123456789abcdef" end', 99), (2, "plain", 5), (3, None, None)]
    clean = redact(spark.createDataFrame(rows, "doc_id long, text string, n_chars long")).collect()
    assert [tuple(r) for r in clean] == [(1, 'é [assign]" end', 15), (2, "plain", 5), (3, None, None)]
    assert redact(docs.limit(0)).count() == 0


OLD_PEM = re.compile(rb"-----BEGIN ((?:[A-Z]+ )?PRIVATE KEY)-----\s*+((?:[A-Za-z][A-Za-z0-9-]*+:[^\n]*+\n)*+)([A-Za-z0-9+/=\s]++)-----END \1-----")
KEY = base64.b64encode(b"\x30\x03abc")
BLOCK_PIECES = [b"-----BEGIN PRIVATE KEY-----", b"-----BEGIN RSA PRIVATE KEY-----", b"-----END PRIVATE KEY-----", b"-----END RSA PRIVATE KEY-----", b"\n", b" ", b"A: b", b"Proc-Type: 4", KEY, b"-", b":"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(BLOCK_PIECES), max_size=14).map(b"".join))
def test_key_blocks_against_one_expression(data):
    """A block's body is one DER sequence, so a whole match is valid if its body is the key once."""
    want, reach = [], 0
    for m in re.finditer(rb"-----BEGIN ", data):
        if m.start() >= reach and (b := OLD_PEM.match(data, m.start())):
            reach = b.end()
            if b"".join(b[3].split()) == KEY:
                want.append(("pem", b.start(), b.end()))
    assert [s for s in byte_spans(keyword_automaton(), data) if s[0] == "pem"] == want


def test_time_grows_with_the_text():
    """1 MB of beginnings that lead nowhere; an hour and more when each reads on to the text's end."""
    size = 1 << 20
    begin = b"-----BEGIN RSA PRIVATE KEY-----\nA:"
    bad = [b"eyJ", b"eyJa.", b"eyJ.", b"eyJa.eyJ", begin, b"-----BEGIN ", b"-----BEGIN PRIVATE KEY-----\n", b"password ", b"token=", b"card 4", b"ghp_", b"AKIA"]
    for piece in bad:
        began = time.process_time()
        byte_spans(keyword_automaton(), piece * (size // len(piece)))
        assert time.process_time() - began < 5, piece


def test_columns_with_the_names_used_inside(spark):
    rows = [(1, "k token = abcdef12", 1, "c", "s", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, __clean string, spans string, __text string")
    got = redact(docs).collect()
    assert [tuple(r) for r in got] == [(1, "k [assign]", 10, "c", "s", "t")]
    r = secrets(docs).collect()[0]
    assert (r["__clean"], r["__text"], len(r["spans"])) == ("c", "t", 1)
