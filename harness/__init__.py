"""Registered queries over the driver tables: the feed made from them, the SQL they are checked by."""
