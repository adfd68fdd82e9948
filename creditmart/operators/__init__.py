"""DataFrame operators: cleansing, quality rules, keys, calendar, star schema, constraints."""
