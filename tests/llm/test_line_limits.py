"""Repeated lines go on hot and on small hosts alike."""

from test_edges import frame

from costlake.llm import line_rules


def test_repeated_lines_go_whatever_the_size_of_the_host(spark):
    prose = lambda i: " ".join(f"w{i}x{k}" for k in range(60))
    footer = "all rights of this page are reserved"
    rows = []
    for host, documents, held in (("hot", 1000, 15), ("small", 30, 8), ("rare", 30, 5)):
        for i in range(documents):
            shared = f"\n{footer}\nMenu" if i < held else ""
            rows.append((len(rows), prose(f"{host}{i}") + shared, "en", host))
    removed = {}
    for r in line_rules.check_lines(frame(spark, rows)).collect():
        removed[r.source] = removed.get(r.source, 0) + (r.n_words - r.words_left)
        assert r.kept
    assert removed == {"hot": 15 * 7, "small": 8 * 7, "rare": 0}
