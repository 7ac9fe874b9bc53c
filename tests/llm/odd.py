"""Tables with the awkward cases every text operator must take, and plain references."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _text long, `a.b` int, _block int, kept string"


def lowered(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def prose(rng: random.Random, n: int, letters: str = "aeioubcdnrst") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n))


def rows(seed: int = 1) -> list[tuple]:
    """Null ids and texts, empties, white space alone, repeats, near copies, odd characters, one long text."""
    rng = random.Random(seed)
    base = prose(rng, 120)
    passage = prose(rng, 45)
    lines = "\n".join(prose(rng, 14) for _ in range(9))
    changed = lines.split("\n")
    changed[3] = "other " + changed[3].split(" ", 1)[1]
    changed[5] += " more"
    changed[7] = changed[7].split(" ", 1)[1].upper()
    texts = [
        None, "", " \n\t ", base, base, base.replace(" ", "  ", 5), base + " end", lines, "\n".join(changed),
        f"{prose(rng, 60)} {passage} {prose(rng, 20)}", f"{prose(rng, 30)}\n{passage}\n{prose(rng, 70)}",
        "one", "a b", "a a a a a a", "É ß \U0001f600 \x00\x1c#*$%&|<>", "▁▁ mark  <|endoftext|> </s> <s>", "x" * 5000,
        "\n".join(["same line of some words here and now ok"] * 6), prose(rng, 30_000), "\r\nwin\r\nlines\r\n",
    ]
    langs, out = ["en", "fr", None], []
    for i, t in enumerate(texts):
        out.append((i * 7 % 101, t, langs[i % 3], f"s{i % 2}" if i % 5 else None, len(t or ""), "x", None, i, i, None))
    out.append((None, base, None, None, None, None, None, None, None, None))
    out.append(out[3])  # a repeated row
    out.append((out[7][0], "another text under the same id " + passage, "en", "s1", 3, "", 1, 1, 1, ""))
    return out


def table(spark, seed: int = 1):
    return spark.createDataFrame(rows(seed), SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(spark, texts: list, first: int = 0):
    """Documents numbered from ``first``."""
    data = [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
