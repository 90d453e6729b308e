"""Composed plans: the six views, bronze → silver → gold, driver-table fixtures,
the registered query catalog and plan inspection."""
