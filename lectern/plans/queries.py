"""All named queries of the library, and their SQL."""

from lectern.plans import catalog, files, flows, learned

#: name: (query, SQL or None where SQL can't express it)
CATALOG = catalog.CATALOG | flows.FLOWS | files.FILES | learned.LEARNED

QUERIES = {name: query for name, (query, _) in CATALOG.items()}
SQL = {name: sql for name, (_, sql) in CATALOG.items() if sql}
