"""Declared relations, foreign keys, score tables and vocabularies.

Fixed values throughout: names, types and order are what existing corpora are written with. No
column may hold NULL; ``-1`` is a value (a root bone, a score that belongs to no view).
"""

from __future__ import annotations

from pyspark.sql import types as T

RELATION_DDL = {
    "bones": "bone_id smallint, name string, parent_bone_id smallint",
    "phenotypes": "phenotype_id smallint, name string",
    "local_changes": "change_id smallint, name string",
    "licenses": "license_id smallint, name string, url string",
    "source_datasets": "dataset_id smallint, name string, license_id smallint",
    "identities": "identity_id int, seed bigint, source_subject string, split string",
    "identity_phenotype": "identity_id int, phenotype_id smallint, value float",
    "identity_local_change": "identity_id int, change_id smallint, value float",
    "motion_clips": "clip_id int, dataset_id smallint, clip_name string, fps float",
    "poses": "pose_id int, clip_id int, frame_index int",
    "pose_rotations": "pose_id int, bone_id smallint, rx float, ry float, rz float",
    "environments": "env_id smallint, name string, hdri_asset string, license_id smallint",
    "scenes": "scene_id int, identity_id int, pose_id int, env_id smallint, seed bigint, split string",
    "cameras": (
        "camera_id bigint, scene_id int, view_index smallint, fx float, fy float, cx float, cy float, "
        "width smallint, height smallint, qx float, qy float, qz float, qw float, tx float, ty float, tz float"
    ),
    "render_runs": "run_id smallint, body_model_version string, renderer string, git_sha string, started_utc string",
    "renders": "render_id bigint, camera_id bigint, run_id smallint",
    "render_data": "render_id bigint, image binary",
    "topologies": "topology_id tinyint, name string, vertex_count int",
    "keypoint_defs": "keypoint_id smallint, name string",
    "keypoint_bone_anchor": "keypoint_id smallint, bone_id smallint",
    "keypoint_vertex_anchor": "keypoint_id smallint, topology_id tinyint, vertex_id int",
    "keypoints_2d": "render_id bigint, keypoint_id smallint, x float, y float, visibility tinyint",
    "segmentation": "render_id bigint, mask binary",
    "meshes": "render_id bigint, topology_id tinyint, geometry binary",
    "edit_models": "edit_model_id smallint, repo_id string, revision string",
    "edit_prompts": "prompt_id int, text string",
    "edit_runs": (
        "edit_run_id int, edit_model_id smallint, prompt_id int, negative_prompt_id int, precision string, "
        "steps smallint, text_guidance_scale float, image_guidance_scale float, started_utc string"
    ),
    "edited_renders": "edit_id bigint, render_id bigint, edit_run_id int, seed bigint, image binary",
}

GENERATED_RELATIONS = ("edit_models", "edit_prompts", "edit_runs", "edited_renders")

# child, child key, parent, parent key
FOREIGN_KEYS = [
    ("identity_phenotype", "identity_id", "identities", "identity_id"),
    ("identity_phenotype", "phenotype_id", "phenotypes", "phenotype_id"),
    ("identity_local_change", "identity_id", "identities", "identity_id"),
    ("identity_local_change", "change_id", "local_changes", "change_id"),
    ("motion_clips", "dataset_id", "source_datasets", "dataset_id"),
    ("poses", "clip_id", "motion_clips", "clip_id"),
    ("pose_rotations", "pose_id", "poses", "pose_id"),
    ("pose_rotations", "bone_id", "bones", "bone_id"),
    ("scenes", "identity_id", "identities", "identity_id"),
    ("scenes", "pose_id", "poses", "pose_id"),
    ("scenes", "env_id", "environments", "env_id"),
    ("cameras", "scene_id", "scenes", "scene_id"),
    ("renders", "camera_id", "cameras", "camera_id"),
    ("renders", "run_id", "render_runs", "run_id"),
    ("render_data", "render_id", "renders", "render_id"),
    ("keypoints_2d", "render_id", "renders", "render_id"),
    ("keypoints_2d", "keypoint_id", "keypoint_defs", "keypoint_id"),
    ("keypoint_bone_anchor", "keypoint_id", "keypoint_defs", "keypoint_id"),
    ("keypoint_bone_anchor", "bone_id", "bones", "bone_id"),
    ("keypoint_vertex_anchor", "keypoint_id", "keypoint_defs", "keypoint_id"),
    ("keypoint_vertex_anchor", "topology_id", "topologies", "topology_id"),
    ("meshes", "render_id", "renders", "render_id"),
    ("meshes", "topology_id", "topologies", "topology_id"),
    ("source_datasets", "license_id", "licenses", "license_id"),
    ("edit_runs", "edit_model_id", "edit_models", "edit_model_id"),
    ("edit_runs", "prompt_id", "edit_prompts", "prompt_id"),
    ("edit_runs", "negative_prompt_id", "edit_prompts", "prompt_id"),
    ("edited_renders", "render_id", "renders", "render_id"),
    ("edited_renders", "edit_run_id", "edit_runs", "edit_run_id"),
]
# Edges older corpora never declared; checked only when asked for.
EXTENDED_KEYS = [
    ("environments", "license_id", "licenses", "license_id"),
    ("segmentation", "render_id", "renders", "render_id"),
]

SCORE_DDL = {
    "root": "key string, task_type string, dimension string, input_column string, input_asset string, input_asset_kind string",
    "candidates": (
        "row_key string, candidate_axis string, rank int, candidate_asset string, candidate_asset_kind string, "
        "candidate_kind string"
    ),
    "scores": (
        "row_key string, candidate_axis string, candidate_rank int, view_index int, metric_name string, metric_value double"
    ),
    "root_extras": "row_key string, extra_name string, extra_value string, extra_kind string",
    "candidate_extras": (
        "row_key string, candidate_axis string, candidate_rank int, extra_name string, extra_value string, extra_kind string"
    ),
}

TASK_TYPES = ("pose_change", "depth_edit", "expression_change", "cross_modal_compose", "speech_edit",
              "instruction_edit", "video_edit")
DIMENSIONS = ("instruction_following", "overall")
ASSET_KINDS = ("soma_mesh", "aov_npz", "soma_rotations", "keypoints_json", "png", "wav_16khz", "text_utf8",
               "video_mp4_h264")
CANDIDATE_ASSET_KINDS = (*ASSET_KINDS, "webvtt")
AXES = ("edit", "audio", "transcript", "view", "frame")
METRICS = ("depth_l1", "normal_l1", "normal_dot", "wavlm_cos", "wer", "clip_cos", "lpips")
EXTRA_KINDS = ("text_utf8", "json_path", "frame_span", "npz_pointer")
# An axis that is absent here has an open vocabulary.
KINDS_BY_AXIS = {
    "audio": ("identity", "pitch_up_mild", "pitch_down_mild", "tempo_fast", "tempo_slow", "combined_subtle",
              "wrong_text_next", "wrong_text_fixed", "wrong_subject", "wrong_all"),
    "transcript": ("voxtral", "whisper", "parakeet", "gemma-auto", "wav2vec2", "ipa-whisper-s", "ipa-whisper-b",
                   "voxtral-ipa", "gemma-ipa", "allosaurus", "allosaurus-eng", "allosaurus-rus"),
}
# (table, column) -> vocabulary
SCORE_VOCABULARIES = {
    ("root", "task_type"): TASK_TYPES,
    ("root", "dimension"): DIMENSIONS,
    ("root", "input_asset_kind"): ASSET_KINDS,
    ("candidates", "candidate_axis"): AXES,
    ("candidates", "candidate_asset_kind"): CANDIDATE_ASSET_KINDS,
    ("scores", "candidate_axis"): AXES,
    ("scores", "metric_name"): METRICS,
    ("root_extras", "extra_kind"): EXTRA_KINDS,
    ("candidate_extras", "candidate_axis"): AXES,
    ("candidate_extras", "extra_kind"): EXTRA_KINDS,
}

FETCH_LIST = ("image_id", "file_name", "coco_url", "license_id")
SHARE_ALIKE = ("Attribution-ShareAlike License",)
COMMERCIAL_LICENSES = ("Attribution License", "Attribution-ShareAlike License", "No known copyright restrictions",
                       "United States Government Work")

ANNOTATION_DDL = (
    "images array<struct<id: bigint, file_name: string, coco_url: string, flickr_url: string, width: bigint, "
    "height: bigint, license: bigint>>, "
    "annotations array<struct<id: bigint, image_id: bigint, category_id: bigint, num_keypoints: int, "
    "keypoints: array<double>, bbox: array<double>, area: double, iscrowd: int, segmentation: string>>, "
    "categories array<struct<id: bigint, name: string, supercategory: string>>, "
    "licenses array<struct<id: bigint, name: string, url: string>>"
)
MODEL_ENTRY_DDL = (
    "struct<name: string, user: string, license: string, vertexCount: bigint, faceCount: bigint, max_texture: bigint, "
    "isRigged: boolean, animation: bigint, glb_paths: array<string>, categories: array<string>, tags: array<string>>"
)


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
