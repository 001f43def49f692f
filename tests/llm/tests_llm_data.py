"""Documents with all that operators must bear: nulls, empty and long texts, ties, repeated rows."""

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
COPY = "The same words in the same order make the same text, said the clerk to the other."

# Columns that bear names the operators use themselves.
CLASHING = (
    "size shard slot rate target source_size taken_times score languages lang_pred keep_id kept digest place gram "
    "class component first n s1 s2 key pos lines tag _part _key _mix _found copy row content"
).split()

HARD = [
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \n\t \x0b\n", None, "a"),
    (4, LONG, "en", "b"),
    (5, COPY, "en", "b"),
    (5, COPY, "en", "b"),
    (6, COPY.replace(" ", "  "), "fr", "b"),
    (7, "one two three", "fr", "c"),
    (8, "ONE two three", None, "c"),
    (9, "12345 67890 !!", "en", "c"),
    (10, LONG + " end", "en", "b"),
    (None, COPY, None, None),
    (None, None, None, None),
    (11, "é Ärger und ß \U0001f600 " * 9, "de", "a"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string"
