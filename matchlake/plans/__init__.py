"""The silver and mart models and the ordered build."""
