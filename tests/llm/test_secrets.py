import base64
import hashlib
import json
import random
import re

from kinfold.llm import secrets as M

from .helpers import frame


def der(tag, *parts):
    body = b"".join(parts)
    n = len(body)
    size = bytes([n]) if n < 128 else bytes([0x80 | (n.bit_length() + 7) // 8]) + n.to_bytes((n.bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


def number(n):
    return der(2, n.to_bytes(n.bit_length() // 8 + 1, "big"))


KEY = der(0x30, number(0), *(number(3**k) for k in (300, 10, 290, 150, 151, 140, 141, 139)))
WRAPPED = der(0x30, number(0), der(0x30, der(6, b"\x2a\x86\x48"), der(5)), der(4, KEY))


def kinds(text):
    return [M.KINDS[k] for _, k, _ in M.find_secrets(text)]


def b64(data):
    return base64.b64encode(data).decode()


def test_base_spans_follow_the_patterns():
    text = 'Password = "abc123def" pw token: "key" token:token"=abcdefgh secret=ABCDE1 AKIA' + "A" * 16 + " AKIAX " + "f" * 24 + "g" + "0" * 23 + " api_key : q=w/e+r"
    want = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        want += [(m.start(), 0, m.end())] if len(m[2]) >= 6 else []
    want += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    want += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    assert M.find_secrets(text) == sorted(want) and len(want) == 5
    assert kinds("ſecret=abcdefgh to\u212aen=abcdefgh") == []  # letters beyond A-Z are no letters of a keyword


def test_structure_confirms():
    armour = f"-----BEGIN RSA PRIVATE KEY-----\n{b64(KEY)}\n-----END RSA PRIVATE KEY-----"
    assert "pem" in kinds(f"x {armour} y")
    assert "pem" in kinds(armour.replace("RSA ", "").replace(b64(KEY), b64(WRAPPED)))
    assert "pem" not in kinds(armour.replace(b64(KEY), b64(KEY[:-1])))
    assert "pem" not in kinds(armour.replace(b64(KEY), "just prose"))
    assert "der" in kinds(f"k {b64(KEY)} z") and "der" not in kinds(f"k {b64(KEY + b'0')} z")
    assert "hexder" in kinds(KEY.hex()) and "hexder" not in kinds(KEY.hex() + "00")
    field = lambda x: len(x).to_bytes(4, "big") + x
    container = b"openssh-key-v1\0" + field(b"none") * 2 + field(b"") + (1).to_bytes(4, "big") + field(b"pub") + field(b"priv")
    assert M.is_key_container(container) and not M.is_key_container(container[:-1]) and not M.is_key_container(container + b"x")


def test_bare_keys_of_any_length_and_after_an_equals_sign():
    assert kinds(f"private_key={b64(KEY)}") == ["der"]
    algorithm = lambda *ids: der(0x30, *(der(6, i) for i in ids))
    p256 = der(0x30, number(0), algorithm(bytes.fromhex("2a8648ce3d0201"), bytes.fromhex("2a8648ce3d030107")), der(4, der(0x30, number(1), der(4, b"\x07" * 32))))
    ed448 = der(0x30, number(0), algorithm(bytes.fromhex("2b6571")), der(4, der(4, b"\x07" * 57)))
    sec1 = der(0x30, number(1), der(4, b"\x07" * 32), der(0xA0, der(6, bytes.fromhex("2a8648ce3d030107"))))
    for key, start in ((p256, "MEECAQAw"), (ed448, "MEcCAQAw"), (sec1, "MDEC")):
        assert b64(key).startswith(start[:2]), b64(key)
        assert kinds(f"k {b64(key)} z") == ["der"] and kinds(f"k={b64(key)}") == ["der"]


def test_wrapped_and_url_safe_keys():
    body = b64(KEY)
    lines = [body[k : k + 64] for k in range(0, len(body), 64)]
    for between in ("\n", "\r\n", "\n    ", "\\n"):
        text = f"key: {between.join(lines)}\nnext line"
        (a, kind, b), = [x for x in M.find_secrets(text) if x[1] >= M.BASE_KINDS]
        assert (M.KINDS[kind], text[a:b]) == ("der", between.join(lines))
    safe = base64.urlsafe_b64encode(KEY + b"").decode().rstrip("=")
    assert kinds(f"k {safe}") == ["der"] and kinds(f"k {safe}A") == []
    assert "der" not in kinds("\n".join(lines[:-1]))
    armour = f"-----BEGIN RSA PRIVATE KEY-----\n{chr(10).join(lines)}\n-----END RSA PRIVATE KEY-----"
    assert [k for k in kinds(armour) if k in ("pem", "der")] == ["pem"]


def test_confirmed_spans_against_planted_ones():
    """Keys and tokens of random sizes and dresses among look-alikes: exactly the planted spans are confirmed."""
    draw = random.Random(11)
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    for _ in range(300):
        text, want = "", []
        for _ in range(draw.randint(1, 6)):
            text += draw.choice(["plain words ", "MAMA and MII ", "line\n", "eyJ.x.y ", "x = ", "Mixed3 ", "30 30aa "])
            small = der(0x30, number(0), der(0x30, der(6, bytes(draw.randint(3, 9)))), der(4, bytes(draw.randrange(256) for _ in range(draw.randint(30, 400)))))
            key = draw.choice([small, der(0x30, number(1), der(4, bytes(draw.randrange(256) for _ in range(draw.randint(24, 90))))), KEY])
            body, kind = draw.choice([b64(key), base64.urlsafe_b64encode(key).decode()]), 5
            shape = draw.randrange(7)
            if shape == 0:
                body = "\n".join(body[k : k + 64] for k in range(0, len(body), 64))
            elif shape == 1:
                body, kind = key.hex(), 6
            elif shape == 2:
                body, kind = f"{part({'alg': 'none'})}.{part({'n': draw.randrange(999)})}.{'s' * draw.randint(0, 9)}", 4
            elif shape == 3:
                body, kind = f"-----BEGIN PRIVATE KEY-----\n{b64(key)}\n-----END PRIVATE KEY-----", 3
            elif shape == 4:  # a length that does not fit
                body, kind = b64(key[:-1]).rstrip("="), None
            elif shape == 5:  # another tag
                body, kind = b64(b"\x31" + key[1:]), None
            if kind is not None:
                want.append((len(text), kind, len(text) + len(body)))
            text += body + " "
        assert [x for x in M.find_secrets(text) if x[1] >= M.BASE_KINDS] == want, text


def test_signed_tokens():
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    token = f"{part({'alg': 'HS256'})}.{part({'sub': 1})}.c2ln"
    assert kinds(f"a {token} b") == ["jwt"]
    assert kinds(f"{part({'typ': 'x'})}.{part({'sub': 1})}.c2ln") == []
    assert kinds("eyJabc.def.ghi") == []


def test_edge_cases(spark):
    rows = M.scan_secrets(frame(spark)).collect()
    assert len(rows) == 10 and all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() and r["spans"] == "" for r in rows)
    assert M.scan_secrets(frame(spark, [])).count() == 0


def test_long_texts_are_linear():
    for text in ("eyJ" * 100_000, "M" * 300_000, "a-b_" * 100_000, "-----BEGIN PRIVATE KEY-----" * 20_000, "30" * 150_000, "token=" * 50_000):
        M.find_secrets(text)


def test_redaction(spark):
    docs = [(1, "é secret=abcdef12 x " + "a" * 30), (2, None), (3, "none")]
    rows = {r["doc_id"]: r["text"] for r in M.redact_secrets(frame(spark, docs)).collect()}
    assert rows == {1: "é [assign] x [hex]", 2: None, 3: "none"}
