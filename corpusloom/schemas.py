"""Declared schemas of all tables; nothing is inferred."""

RAW_TWEETS = "id bigint, text string, keyword string, location string, target int"
CORPUS = "message_id string, raw_text string, source string"
TOKENS = (
    "message_id string, token_idx int, token string, pos string, tag_ string, dep string, lemma string, "
    "is_ent int, bio_tag string"
)
PROMPTS = "prompt_id string, category string, prompt string"
RESPONSES = "response_id string, prompt_id string, prompt string, response_text string, source_type string"
CLUSTERS = "response_id string, source_type string, kmeans_cluster int, hierarchical_cluster int"
IMPORTANCES = "feature string, model string, importance double"
TICKETS = "type string, subject string, body string, language string, priority string"
SUMMARY = (
    "classification array<struct<model:string,accuracy:double,precision:double,recall:double,f1:double>>, "
    "top_features map<string,double>, cluster_alignment struct<kmeans_ari:double,hierarchical_ari:double>"
)
