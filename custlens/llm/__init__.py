"""Training-data operators: language ID, LM scoring, near-duplicate joins,
vector search, chat formatting, URL filters, packing, sharding,
decontamination and toxicity.  Nothing else in ``custlens`` imports this
subpackage."""
