"""The weekly tables: how sources are prepared and which tables come out of them."""
