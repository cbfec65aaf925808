"""Quality dimensions, their tag requirements, routing and screening parameters (fixed values)."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Requirement:
    """Tag requirement of one dimension; ``required=None`` means no requirement at all."""

    required: tuple | None = None
    alternative: tuple = ()
    preferred: tuple = ()


# perspective -> [(dimension, controllability)]
TAXONOMY = {
    "technical_quality": [
        ("blur", "L1"), ("overexposure", "L1"), ("underexposure", "L1"), ("low_contrast", "L2"),
        ("color_cast", "L1"), ("desaturation", "L1"), ("plastic_waxy_texture", "L2")],
    "aesthetic_quality": [
        ("awkward_positioning", "L1"), ("awkward_framing", "L1"), ("unbalanced_layout", "L1"),
        ("cluttered_scene", "L1"), ("lighting_imbalance", "L2"), ("color_clash", "L1"),
        ("dull_palette", "L1")],
    "semantic_rationality": [
        ("hand_malformation", "L2"), ("expression_mismatch", "L1"),
        ("body_proportion_error", "L1"), ("extra_limbs", "L2"), ("animal_anatomy_error", "L2"),
        ("object_structure_error", "L2"), ("material_mismatch", "L1"), ("extra_objects", "L1"),
        ("count_error", "L1"), ("illogical_colors", "L1"), ("scale_inconsistency", "L1"),
        ("floating_objects", "L1"), ("penetration_overlap", "L2"), ("context_mismatch", "L1"),
        ("time_inconsistency", "L1"), ("scene_layout_error", "L2"), ("text_error", "L2"),
        ("logo_symbol_error", "L2")],
}
DIMENSIONS = [name for dims in TAXONOMY.values() for name, _ in dims]
PERSPECTIVE_OF = {name: p for p, dims in TAXONOMY.items() for name, _ in dims}

SEMANTIC_SUBGROUPS = {
    "semantic_anatomy": ["hand_malformation", "expression_mismatch", "body_proportion_error",
                         "extra_limbs", "animal_anatomy_error"],
    "semantic_object": ["object_structure_error", "material_mismatch", "extra_objects",
                        "count_error", "illogical_colors"],
    "semantic_spatial": ["scale_inconsistency", "floating_objects", "penetration_overlap",
                         "context_mismatch", "time_inconsistency", "scene_layout_error"],
    "semantic_text": ["text_error", "logo_symbol_error"],
}

# Tag requirements by dimension; a dimension without an entry accepts every prompt.
REQUIREMENTS = {
    "hand_malformation": Requirement(("has_hand",), (), ("has_person",)),
    "expression_mismatch": Requirement(("has_face",), (), ("has_person",)),
    "body_proportion_error": Requirement(("has_person",), (), ("has_full_body",)),
    "extra_limbs": Requirement(("has_person",)),
    "animal_anatomy_error": Requirement(("has_animal",)),
    "text_error": Requirement(("has_text",)),
    "logo_symbol_error": Requirement(("has_logo_or_symbol", "has_text")),
    "count_error": Requirement(None, (), ("has_countable_objects",)),
    "object_structure_error": Requirement(("has_structured_object",)),
    "material_mismatch": Requirement(("has_structured_object",)),
    "scale_inconsistency": Requirement(None, (), ("has_multiple_objects",)),
    "penetration_overlap": Requirement(None, (), ("has_multiple_objects",)),
    "scene_layout_error": Requirement(None, (), ("has_indoor_scene",)),
    "plastic_waxy_texture": Requirement(None, (), ("has_person", "has_face")),
}

# Run-time filter: any of these tags admits a prompt to the dimension.
RUNTIME_REQUIRED_TAGS = {
    "expression_mismatch": ["has_face"],
    "body_proportion_error": ["has_person"],
    "extra_limbs": ["has_person"],
    "hand_malformation": ["has_hand"],
    "animal_anatomy_error": ["has_animal"],
    "object_structure_error": ["has_structured_object"],
    "material_mismatch": ["has_structured_object"],
    "count_error": ["has_countable_objects"],
    "scale_inconsistency": ["has_multiple_objects"],
    "scene_layout_error": ["has_background"],
    "context_mismatch": ["has_background"],
    "illogical_colors": ["has_person", "has_animal", "has_background"],
}

# Routing of dimensions to pool strategies; dimensions not listed use the global pool.
GLOBAL_POOL = "global_cleaned_pool"
SPECIAL_POOL = "existing_special_pool"
RULE_THEN_SCREEN = "rule_recall_then_llm_screen"
RULE_ONLY = "rule_recall_only"
REUSE_SCREEN = "reuse_common_semantic_screen_then_token_filter"
REUSE_RULE = "reuse_common_rule_pool_then_token_filter"
SPECIAL_POOL_DIMENSIONS = ["hand_malformation", "expression_mismatch", "animal_anatomy_error",
                           "text_error", "logo_symbol_error"]
# (dimension, family, base tags)
SCREENED_ROUTES = [
    ("body_proportion_error", "human_full_body_realistic", ["has_person"]),
    ("extra_limbs", "human_full_body_realistic", ["has_person"]),
    ("object_structure_error", "structured_object_primary", ["has_structured_object"]),
    ("material_mismatch", "structured_object_primary", ["has_structured_object"]),
    ("scale_inconsistency", "multi_object_reference", ["has_multiple_objects"]),
    ("penetration_overlap", "multi_object_reference",
     ["has_multiple_objects", "has_structured_object"]),
]
RULE_ONLY_DIMENSION = "floating_objects"
RULE_ONLY_TAGS = ["has_structured_object", "has_countable_objects", "has_person", "has_animal"]


def routing_rows(dimensions=None):
    """One routing row per configured dimension."""
    screened = {d: (family, tags) for d, family, tags in SCREENED_ROUTES}
    rows = []
    for dim in dimensions or DIMENSIONS:
        if dim in screened:
            family, tags = screened[dim]
            rows.append((dim, RULE_THEN_SCREEN, tags, family, True, REUSE_SCREEN))
        elif dim == RULE_ONLY_DIMENSION:
            rows.append((dim, RULE_ONLY, RULE_ONLY_TAGS, None, False, REUSE_RULE))
        elif dim in SPECIAL_POOL_DIMENSIONS:
            rows.append((dim, SPECIAL_POOL, [], None, False, None))
        else:
            rows.append((dim, GLOBAL_POOL, [], None, False, None))
    return rows


ROUTING_SCHEMA = ("dimension string, strategy string, base_tags array<string>, "
                  "shared_pool_family string, llm_screening_required boolean, "
                  "turbo_pool_strategy string")

# Screening families: base tags, and the wider tag set of the light prefilter.
FAMILY_BASE_TAGS = {
    "human_full_body_realistic": ["has_person"],
    "structured_object_primary": ["has_structured_object"],
    "multi_object_reference": ["has_multiple_objects"],
}
FAMILY_PREFILTER_ANY = ["has_multiple_objects", "has_person", "has_animal",
                        "has_structured_object", "has_countable_objects"]
FAMILY_DIMENSIONS = {
    "human_full_body_realistic": ["body_proportion_error", "extra_limbs"],
    "structured_object_primary": ["material_mismatch", "object_structure_error"],
    "multi_object_reference": ["penetration_overlap", "scale_inconsistency"],
}

# Screening spec overrides by dimension.
SCREENING_OVERRIDES = [
    ("body_proportion_error", "human_full_body_realistic", None, True, None, REUSE_SCREEN),
    ("extra_limbs", "human_full_body_realistic", None, True, None, REUSE_SCREEN),
    ("object_structure_error", "structured_object_primary", None, True, None, REUSE_SCREEN),
    ("material_mismatch", "structured_object_primary", None, True, None, REUSE_SCREEN),
    ("scale_inconsistency", "multi_object_reference", None, True, None, REUSE_SCREEN),
    ("penetration_overlap", "multi_object_reference", None, True, None, REUSE_SCREEN),
    ("floating_objects", None, RULE_ONLY, False, RULE_ONLY_TAGS, REUSE_RULE),
]
SCREENING_OVERRIDES_SCHEMA = ("dimension string, o_family string, o_builder_mode string, "
                              "o_screen boolean, o_base_tags array<string>, o_turbo string")

# Token budgets of the short-prompt pools.
GLOBAL_MAX_TOKENS = 50
STRICT_MAX_TOKENS = 40
STRICT_DIMENSIONS = ["awkward_framing", "awkward_positioning", "body_proportion_error",
                     "cluttered_scene", "color_cast", "hand_malformation", "lighting_imbalance",
                     "low_contrast", "overexposure", "unbalanced_layout", "underexposure"]

# Guardrails of evolved templates: dimension -> (must keep, must avoid); other dimensions are free.
GUARDRAILS = {
    "blur": (["blur", "out of focus"], ["sharp", "high resolution", "crystal clear"]),
    "overexposure": (["bright", "overexposed"], ["dark", "moody"]),
    "underexposure": (["dark", "underexposed"], ["bright", "vivid"]),
    "color_cast": (["color", "tint"], ["natural colors", "accurate colors"]),
    "hand_malformation": (["hand", "finger"], ["perfect hands", "detailed hands"]),
    "face_asymmetry": (["face", "asymmetric"], ["symmetrical", "perfect face"]),
}
# (model, dimension) combinations declared unusable.
INCOMPATIBLE_MODELS = [("sdxl", d) for d in [
    "awkward_framing", "unbalanced_layout", "lighting_imbalance", "extra_objects",
    "illogical_colors", "floating_objects", "penetration_overlap", "context_mismatch",
    "time_inconsistency", "scene_layout_error"]]

# Style anchors put before a prompt, by detected style.
STYLE_ANCHORS = {
    "realistic": "realistic style, photorealistic, lifelike,",
    "illustration": "illustration style, digital art, stylized,",
    "painting": "painting style, artistic,",
}
# Anchors put before the positive prompt when the judge finds its style unsuitable.
POSITIVE_ANCHORS = {
    "realistic": "realistic style, photorealistic, ",
    "illustration": "illustration style, ",
    "painting": "painting style, ",
}
# Feedback texts by failure type.
FEEDBACK = {
    "positive_content_mismatch": "The positive image content cannot carry this degradation "
    "dimension (e.g., no face for expression_mismatch). Skip this prompt.",
    "positive_incompatible": "The positive image style is not suitable for this degradation "
    "dimension. This should not happen in retry - check logic.",
    "style_drift": "The negative image changed rendering style. Keep the EXACT SAME style as the "
    "positive prompt. Only degrade quality in the target dimension.",
    "content_drift": "The negative image changed subject/content too much. Keep the SAME subject "
    "and scene composition. Only introduce degradation in the target dimension.",
    "insufficient_effect": "The degradation effect is too subtle or invisible. Make the "
    "degradation STRONGER and MORE OBVIOUS. Use more explicit degradation keywords.",
}
FEEDBACK_DEFAULT = "Previous attempt was rejected. Please try a different approach."

SEVERITIES = ["mild", "moderate", "severe"]
# Cumulative severity shares: 0.2 mild, 0.4 moderate, 0.4 severe.
SEVERITY_SHARES = [("mild", 0.2), ("moderate", 0.6), ("severe", 1.0)]

# Public sources in catalog order, with candidate and selected sizes where they are known.
SOURCES = ["diffusiondb", "pick_a_pic_v2", "t2i_compbench", "parti_prompts", "longbench_t2i"]
BUCKETS = {
    "diffusiondb": ["people_face_hands", "animals", "multi_object_spatial", "count_constraints",
                    "text_sign_logo", "reflection_optics", "general_scenes"],
    "pick_a_pic_v2": ["people_and_activities", "multi_subject_interaction",
                      "explicit_action_expression", "creative_but_structured"],
}
