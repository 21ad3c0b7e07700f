"""Rows that every operator must stand."""

FOLDER = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 997}x{i // 997}" for i in range(60_000))
EDGES = [
    (1, None, None, None),
    (2, "", "en", None),
    (3, " \t\n ", None, "a"),
    (4, "one", "en", "a"),
    (5, "one two", "en", "a"),
    (6, LONG, "en", "a"),
    (7, LONG, "en", "b"),
    (None, "no id here at all", "en", "a"),
    (None, "no id here at all", "en", "a"),
    (8, "the same row twice over", "en", "b"),
    (8, "the same row twice over", "en", "b"),
    (9, "naïve café 日本語 \U0001f600 text", "fr", "c"),
    (10, "tail\x0bseparated\x0cby odd\rwhite\tspace\n\n\nlines", "fr", None),
]
