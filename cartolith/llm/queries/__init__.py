"""The registered queries over whole tables, and their SQL."""
