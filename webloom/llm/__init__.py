"""Training-data operators: deduplication, language identification, archives,
mixing, vector search, chat formatting, URL lists, tokenisation and language
model scoring.  Nothing outside this subpackage imports it."""
