"""End-to-end jobs and shared input builders."""
