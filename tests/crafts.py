"""A small corpus of entities for the recommender's tests."""

#: Entities with profile texts of crafts: (id, name, group, tokens).
PROFILES = [
    (5, "Faro Velho", "QA", "coast qa weaving_strong pottery_some"),
    (8, "Faro Novo", "QA", "coast qa weaving_strong pottery_some glass_few"),
    (9, "Lagoa", "QB", "coast qb glass_strong"),
    (14, "Lagôa", "QC", "plain qc glass_strong weaving_few"),
    (21, "Monte Claro", "QC", "plain qc pottery_strong"),
    (22, "Serra Funda", "QD", "ridge qd pottery_some"),
    (30, "Faro Velho", "QD", "ridge qd weaving_strong pottery_some glass_few"),
    (37, "Vale do Ipê", "QE", "plain qe nothing_made"),
]
