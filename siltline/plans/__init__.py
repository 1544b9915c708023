"""The worked example: silver tables, staging views, star schema, quality suite and questions."""
