"""Chunks against a plain reading of the rules, letter by letter, on any Markdown."""

from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.operators import chunk


def count(text):
    return len(text.split()) * 13 // 10


def headings(text):
    """(start, end, level, title): hash signs at a line's start, white space, the rest of the line it leads to."""
    found, at = [], 0
    while at < len(text):
        line = at
        while at < len(text) and text[at] == "#":
            at += 1
        level, gap = at - line, at
        while gap < len(text) and text[gap].isspace():
            gap += 1
        if 1 <= level <= 6 and gap > at:
            end = text.find("\n", gap)
            end = len(text) if end < 0 else end
            found.append((line, end, level, text[gap:end].strip()))
            at = end
        next_line = text.find("\n", at if level and found and found[-1][0] == line else line)
        if next_line < 0:
            break
        at = next_line + 1
    return found


def pieces(body, fences):
    """Paragraphs between blank lines; fenced text in one."""
    out = []
    while fences and (opening := body.find("```")) >= 0 and (closing := body.find("```", opening + 3)) >= 0:
        out += body[:opening].split("\n\n") + [body[opening : closing + 3]]
        body = body[closing + 3 :]
    return [p for p in out + body.split("\n\n") if p.strip()]


def has_tagged_fence(body):
    """Three ticks, word letters, a line end, and three ticks somewhere after."""
    at = body.find("```")
    while at >= 0:
        end = at + 3
        while end < len(body) and (body[end].isalnum() or body[end] == "_"):
            end += 1
        if end < len(body) and body[end] == "\n" and body.find("```", end + 1) >= 0:
            return True
        at = body.find("```", at + 1)
    return False


def expected(text, size, overlap, least, most, keep):
    marks = headings(text)
    sections = []
    if not marks:
        sections.append(([], "", text))
    elif text[: marks[0][0]].strip():
        sections.append(([], "", text[: marks[0][0]].strip()))
    trail = []
    for k, (_, end, level, title) in enumerate(marks):
        trail = [t for t in trail if t[0] < level] + [(level, title)]
        body = text[end : marks[k + 1][0] if k + 1 < len(marks) else len(text)].strip()
        sections.append(([t for _, t in trail], "#" * level + " " + title, body))
    base, group, used, path = [], [], 0, []

    def end_group():
        whole = "\n\n".join(g for g in group if g.strip())
        if whole.strip() and count(whole) >= least:
            base.append((whole, path))

    for names, line, body in sections:
        if count(body) > most:
            end_group()
            group, used = [], 0
            part, n = [], 0
            for p in pieces(body, keep and has_tagged_fence(body)):
                if part and n + count(p) > size:
                    base.append(("\n\n".join(part), names))
                    part, n = [], 0
                part.append(p)
                n += count(p)
            if part:
                base.append(("\n\n".join(part), names))
            continue
        if used and used + count(body) > size:
            end_group()
            group, used = [], 0
        path = names
        group.append(line + ("\n\n" + body if line and body else body))
        used += count(body)
    end_group()
    out = []
    for whole, names in base:
        tail = " ".join(out[-1][0].split()[-max(1, int(overlap / 1.3)) :]) if out and overlap else ""
        out.append((tail + "\n\n" + whole if tail else whole, whole, names))
    return out


line = st.one_of(
    st.builds(lambda n, t: "#" * n + t, st.integers(1, 7), st.sampled_from([" Title", "\tA b", "", " ", "x", " Title  ", " # y"])),
    st.sampled_from(["", "", "one two three", "four five six seven eight nine", "```py", "```", "```\nx = 1\n```", "```js\n# not a heading\n\nf()\n```", "  indented words here", "a ``` b"]),
)


@settings(max_examples=400, deadline=None)
@given(st.lists(line, max_size=25), st.integers(2, 20), st.integers(0, 3), st.integers(0, 6), st.integers(2, 25), st.booleans())
def test_chunks_by_the_rules(lines, size, overlap, least, most, keep):
    text = "\n".join(lines)
    config = chunk.ChunkConfig(size, min(overlap, size - 1), least, most, keep)
    assert chunk.chunks_of(text, config) == expected(text, size, min(overlap, size - 1), least, most, keep)


def test_known_document():
    text = "intro words\n\n# A\n\n" + "alpha " * 10 + "\n\n## B\n\n" + "beta " * 10 + "\n\n```py\nx\n\ny\n```\n\n# C\n\nend"
    got = chunk.chunks_of(text, chunk.ChunkConfig(20, 3, 1, 100, True))
    assert [g[2] for g in got] == [["A"], ["C"]] and got[1][0].startswith("alpha alpha\n\n## B") and got[1][1].endswith("# C\n\nend")
