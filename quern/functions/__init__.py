"""Part of quern."""
