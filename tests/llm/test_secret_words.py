from trialcohort.llm import secret_entropy

TOKEN = "k9Zx+Q7pLmW2vB4nT8rYc1dF3gHs6JuKe5oPqRiA"


def test_allowed_words_hide_only_windows_that_overlap_them(make):
    found = [f"EXAMPLE_KEY={TOKEN}", f"host/example/{TOKEN}", f"{TOKEN}-xxxxxxx", f"0123456789/{TOKEN[:20]}", f"placeholder{TOKEN}abcdefghij", TOKEN]
    clear = [
        f"{TOKEN[:19]}example{TOKEN[19:38]}", f"{TOKEN[:19]}xxxxxx{TOKEN[:19]}", f"examplexample{TOKEN[:19]}", "0123456789abcdefghijABCDEFGHIJ",
        "550e8400-e29b-41d4-a716-446655440000", f"sha256-{TOKEN}", "example-example-example-1",
    ]
    rows = secret_entropy.secrets(make(list(enumerate(found + clear)))).collect()
    spans = {r.doc_id: r.spans for r in rows}
    for k, text in enumerate(found):
        assert spans[k] == f"entropy:0:{len(text)}", text
    for k, text in enumerate(clear, len(found)):
        assert spans[k] == "", text
