"""Fixed texts of screening and backfill requests."""

# Decision rules by screening policy.
SCREENING_RULES = {
    "lenient": [
        "Decision rule (LENIENT):",
        "- pass: prompt likely contains enough semantic cues so generated images can expose this "
        "dimension for degradation.",
        "- fail: prompt is clearly irrelevant/impossible for this dimension or already describes "
        "degraded output.",
        "- uncertain: borderline/ambiguous cases.",
    ],
    "strict": [
        "Decision rule (STRICT):",
        "- pass: prompt clearly contains semantic elements needed to evaluate this dimension as a "
        "clean positive anchor.",
        "- fail: prompt clearly lacks required elements or is unsuitable/noisy for this "
        "dimension.",
        "- uncertain: ambiguous or insufficiently specified.",
    ],
}
SCREENING_TASK = ("Task: For each prompt, return label in {pass, fail, uncertain}, confidence in "
                  "[0,1], and short reason.")
SCREENING_SCHEMA = ('{"dimension":"...","results":[{"sample_id":"...","label":'
                    '"pass|fail|uncertain","confidence":0.0,"reason":"..."}]}')

# Pass and fail criteria by family.
FAMILY_CRITERIA = {
    "human_full_body_realistic": (
        ["at least one readable main human subject",
         "body, limbs, or head-to-body relation is likely readable",
         "multi-person scenes are allowed if one main subject is still clearly readable",
         "stylization is allowed if the human body remains readable enough for later anatomy "
         "degradation"],
        ["only face / portrait / close-up without usable body proportion cues",
         "non-human or heavily transformed humanoid presentation",
         "heavily obscured or structurally unreadable body",
         "mannequin / statue / toy / doll instead of a real human subject",
         "explicit bed / erotic / adult-pose content"]),
    "structured_object_primary": (
        ["one dominant structured non-living object",
         "shape, parts, or surface material are likely readable",
         "stylization is allowed if the main object remains clear and dominant"],
        ["humans or animals as the main subject",
         "the main object is too minor, too crowded, or too unclear to read well",
         "mostly abstract scenery or environment without a dominant structured object"]),
    "multi_object_reference": (
        ["at least two readable entities, or one main subject with a clear reference context",
         "entities may be objects, humans, or animals",
         "boundaries, contact, or size-reference relations are likely readable",
         "stylization is allowed if relations remain readable"],
        ["single isolated subject without a useful reference context",
         "boundaries or object relations are too vague to compare",
         "scene is too abstract or too unreadable for later relation-based degradation"]),
}
FAMILY_CRITERIA_DEFAULT = (
    ["prompt likely contains the core semantic prerequisites for this shared family"],
    ["prompt likely lacks the core semantic prerequisites for this shared family"])

# Generation instructions by template family.
TEMPLATE_INSTRUCTIONS = {
    "text_literal_template":
        "Each prompt must include an explicit text carrier and quoted readable literal text. "
        "Prefer signs, labels, menus, packaging, covers, or screens. "
        "The text itself must be correct and clearly readable, with no spelling mistakes, "
        "garbling, or malformed typography.",
    "hands_visible_template":
        "Each prompt must make hands clearly visible and engaged in a concrete action or "
        "interaction. Prefer holding, pointing, typing, drawing, cooking, or similar hand-centric "
        "actions. Hands must appear natural, complete, and anatomically normal.",
    "portrait_face_template":
        "Each prompt must present a clearly visible face with portrait or close-up framing, plus "
        "an explicit facial expression. The face should remain natural, symmetric, and cleanly "
        "rendered.",
    "full_body_human_template":
        "Each prompt must make the full human body or whole-body pose clearly visible, with a "
        "natural but explicit pose description. Body proportions and pose must remain physically "
        "plausible and anatomically normal.",
    "animal_focus_template":
        "Each prompt must keep one clear animal subject visually dominant with low background "
        "ambiguity. The animal anatomy must remain natural and biologically plausible.",
    "structured_object_template":
        "Each prompt must feature a clearly bounded man-made object with stable structure and "
        "recognizable parts. Object form should remain coherent, complete, and logically "
        "assembled.",
    "relation_count_template":
        "Each prompt must include explicit countable entities or quantity cues, with counts or "
        "count-sensitive wording. The described counts, sizes, and object identities should "
        "remain internally consistent.",
    "multi_object_layout_template":
        "Each prompt must include multiple objects or a structured spatial layout only when "
        "needed for the target relation or composition. Spatial arrangement should remain "
        "coherent, non-overlapping unless naturally intended, and physically plausible.",
    "generic_scene_context_template":
        "Each prompt must include enough scene context to define environment logic while keeping "
        "the key subject and relations attributable. Scene context must remain logically "
        "consistent and visually coherent.",
    "lighting_exposure_anchor_template":
        "Each prompt should include semantically clean lighting context without introducing "
        "style-heavy quality booster language. Lighting and exposure should remain natural and "
        "well-controlled.",
    "lighting_anchor_template":
        "Each prompt should include a clear light source or lighting geometry that remains "
        "semantically natural. Lighting direction, shadows, and illumination cues should remain "
        "internally consistent.",
    "color_tone_anchor_template":
        "Each prompt should include stable color-bearing subjects or palettes that are easy to "
        "preserve as positive anchors. Colors should remain believable, harmonious, and "
        "semantically appropriate.",
    "generic_quality_anchor_template":
        "Each prompt should be a clean, semantically natural positive anchor with readable "
        "structure and minimal style noise. Do not imply blur, distortion, bad composition, "
        "artifacts, or other quality defects.",
}
DEFAULT_INSTRUCTION = ("Use clear subject, scene, and attribute wording that keeps the target "
                       "structure visually salient.")
ANCHOR_INSTRUCTION = ("The prompt must not already exhibit the target degradation. It should "
                      "describe a clean positive anchor where the relevant structure is clearly "
                      "present, natural, and intact.")

# Screening goal and focus cues of the shared families.
FAMILY_GOALS = {
    "human_full_body_realistic": (
        "保留至少一个可读主人物的人体场景，优先自然人体呈现，并让身体、肢体或头身比例线索足够清楚，供 body_proportion_error 和 extra_limbs 复用。",
        ["at least one readable main human subject",
         "natural human presentation is preferred, but stylization is allowed if body readability remains clear",
         "body, limbs, or head-to-body relation should be readable enough for later anatomical degradation",
         "multi-person scenes are allowed when one main subject remains clearly readable",
         "exclude non-human or heavily transformed humanoids, mannequin-like subjects, and explicit adult-pose prompts"]),
    "structured_object_primary": (
        "保留有单个主导性结构化非生物物体的 prompt，确保轮廓、部件和材质观感可读。",
        ["one dominant structured non-living object",
         "shape, parts, and surface material are easy to perceive",
         "exclude biology-dominant or overly crowded scenes"]),
    "multi_object_reference": (
        "先做轻量规则预筛，再保留多个可读实体、或一个主体加清楚参照关系的 prompt；实体可以是物体、人或动物。",
        ["entities may be objects, humans, or animals",
         "at least two readable entities, or one main subject with a clear reference context",
         "object boundaries or object relations are readable",
         "do not require highly explicit geometric language"]),
}

DEFAULT_SCENE_BUCKET = "objects_products_tools"


def screening_lines(policy):
    """Lines of a screening request between its first line and the prompts."""
    return [SCREENING_TASK, *SCREENING_RULES[policy], "Output JSON schema:", SCREENING_SCHEMA,
            "Prompts:"]


def family_lines(family, goal, focus, dimensions):
    """Lines of a family screening request before the prompts."""
    passes, fails = FAMILY_CRITERIA.get(family, FAMILY_CRITERIA_DEFAULT)
    schema = ('{"family_name":"' + family + '","results":[{"sample_id":"...","label":"pass|fail",'
              '"reason":"..."}]}')
    return [f"Shared family: {family}", f"Target dimensions: {', '.join(dimensions)}", "",
            f"Screening goal: {goal}", "", "Pass criteria:", *[f"- {p}" for p in passes], "",
            "Fail criteria:", *[f"- {f}" for f in fails], "", "Family focus cues:",
            *[f"- {f}" for f in focus], "", "Output JSON schema:", schema, "", "Prompts:"]
