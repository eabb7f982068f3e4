"""Training-data operators (near-duplicates, WARC, language id, licences, decontamination, URL
filters, tokenising, line dedup, quality).  Nothing outside this package imports it."""
