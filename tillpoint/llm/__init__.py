"""Training-data operators: decontamination, near-duplicate removal, fixity
audits, toxicity tagging, URL filtering, token counting, packing, language model
scoring, tokenizer alignment, quality rules and conversation repair. Nothing else
in the library imports this subpackage."""
