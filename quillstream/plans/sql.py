"""SQL that several query modules share."""

#: The default analyzer's tokens in DuckDB.
SQL_TOKENS = r"list_transform(string_split_regex(regexp_replace(regexp_replace(text, '^\s+|\s+$', '', 'g'), '-\s+(\S)', '\1', 'g'), '\s+'), lambda t: lower(regexp_replace(t, '^[[:punct:]]+|[[:punct:]]+$', '', 'g')))"

SQL_TERMS = f"(SELECT doc_id, t.pos - 1 AS pos, t.term AS term FROM (SELECT doc_id, unnest(list_transform({SQL_TOKENS}, lambda x, i: {{'pos': i, 'term': x}})) AS t FROM documents) WHERE t.term <> '')"

#: Trigrams of texts in a table, by a key, with their counts.
SQL_TRIGRAMS = "(SELECT k, substr(p, i, 3) AS gram, count(*) AS n FROM (SELECT k, p, unnest(range(1, greatest(length(p) - 2, 1) + 1)) AS i FROM (SELECT %s AS k, regexp_replace(lower(' ' || text || ' '), '[^\\p{L}]+', ' ', 'g') AS p FROM %s)) GROUP BY ALL)"
