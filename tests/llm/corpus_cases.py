"""Schema shared by the corpus tests."""
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
