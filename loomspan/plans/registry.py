"""Names of the 270 indicators in the order of the output documents."""

from __future__ import annotations

import re

from loomspan.functions.stats import STATS

# Indicator names of each modality.
EYE = (
    "gaze_position_x",
    "gaze_position_y",
    "gaze_velocity",
    "gaze_velocity_x",
    "gaze_velocity_y",
    "gaze_acceleration",
    "gaze_acceleration_x",
    "gaze_acceleration_y",
    "gaze_jerk",
    "gaze_jerk_x",
    "gaze_jerk_y",
    "gaze_path_length",
    "gaze_path_displacement",
    "gaze_path_curvature",
    "fixation_rate",
    "fixation_duration",
    "fixation_bbox_width",
    "fixation_bbox_height",
    "fixation_bbox_aspect_ratio",
    "range_based_fixation_dispersion",
    "rms_based_fixation_dispersion",
    "bbox_area_based_fixation_dispersion",
    "fixation_entropy",
    "saccade_rate",
    "saccade_duration",
    "saccade_bbox_width",
    "saccade_bbox_height",
    "saccade_bbox_aspect_ratio",
    "range_based_saccade_dispersion",
    "rms_based_saccade_dispersion",
    "bbox_area_based_saccade_dispersion",
    "saccade_entropy",
    "saccade_displacement",
    "saccade_velocity",
    "saccade_velocity_x",
    "saccade_velocity_y",
    "saccade_acceleration",
    "saccade_acceleration_x",
    "saccade_acceleration_y",
    "saccade_jerk",
    "saccade_jerk_x",
    "saccade_jerk_y",
    "first_saccade_latency",
    "first_saccade_duration",
    "saccade_direction",
    "saccade_angular_velocity",
    "saccade_path_length",
    "saccade_path_curvature",
    "range_based_saccade_endpoint_dispersion",
    "rms_based_saccade_endpoint_dispersion",
    "bbox_area_based_saccade_endpoint_dispersion",
    "saccade_endpoint_covariance",
    "first_fixation_latency",
    "first_fixation_duration",
    "on_screen_duration",
    "on_screen_gaze_ratio",
    "off_screen_duration",
    "off_screen_gaze_ratio",
    "gaze_bbox_width",
    "gaze_bbox_height",
    "gaze_bbox_aspect_ratio",
    "range_based_gaze_dispersion",
    "rms_based_gaze_dispersion",
    "bbox_area_based_gaze_dispersion",
    "gaze_covariance",
    "gaze_entropy",
    "horizontal_saccade_rate",
    "vertical_saccade_rate",
    "edge_gaze_ratio",
    "left_half_gaze_ratio",
    "right_half_gaze_ratio",
    "top_half_gaze_ratio",
    "bottom_half_gaze_ratio",
    "central_gaze_ratio",
    "range_based_fixation_centroid_dispersion",
    "rms_based_fixation_centroid_dispersion",
    "bbox_area_based_fixation_centroid_dispersion",
    "fixation_centroid_covariance",
    "fixation_convex_hull_area",
    "fixation_convex_hull_perimeter",
    "fixational_drift_velocity",
    "fixational_drift_velocity_x",
    "fixational_drift_velocity_y",
    "scanpath_fractal_dimension",
    "scanpath_revisit_ratio",
    "scanpath_determinism_ratio",
    "fixation_saccade_ratio",
    "inter_fixation_interval",
    "inter_saccade_interval",
    "gaze_offset_to_screen_center",
    "central_bias",
    "backtrack_saccade_rate",
    "backtrack_saccade_ratio",
)

KEYBOARD = (
    "total_keystroke_count",
    "character_keystroke_count",
    "non_character_keystroke_count",
    "first_keystroke_latency",
    "typing_duration",
    "typing_velocity",
    "down_down_interval",
    "up_down_interval",
    "up_up_interval",
    "key_overlap_duration",
    "key_overlap_ratio",
    "ngram_typing_duration",
    "inter_word_interval",
    "pause_duration",
    "pause_ratio",
    "burst_length",
    "burst_duration",
    "burst_velocity",
    "key_hold_duration",
    "alphabetic_key_hold_duration",
    "alphabetic_key_ratio",
    "spacebar_key_hold_duration",
    "spacebar_key_ratio",
    "backspace_key_hold_duration",
    "backspace_key_ratio",
    "delete_key_hold_duration",
    "delete_key_ratio",
    "enter_key_hold_duration",
    "enter_key_ratio",
    "capslock_key_hold_duration",
    "capslock_key_ratio",
    "shift_key_hold_duration",
    "shift_key_ratio",
    "control_key_hold_duration",
    "control_key_ratio",
    "alt_key_hold_duration",
    "alt_key_ratio",
    "tab_key_hold_duration",
    "tab_key_ratio",
    "escape_key_hold_duration",
    "escape_key_ratio",
    "insert_key_hold_duration",
    "insert_key_ratio",
    "punctuation_key_hold_duration",
    "punctuation_key_ratio",
    "digit_key_hold_duration",
    "digit_key_ratio",
    "cursor_move_key_duration",
    "cursor_move_key_ratio",
    "undo_duration",
    "undo_ratio",
    "paste_duration",
    "paste_ratio",
    "cut_duration",
    "cut_ratio",
    "copy_duration",
    "copy_ratio",
    "key_category_entropy",
    "ngram_distribution_entropy",
    "key_sequence_levenshtein_distance",
    "ngram_distribution_similarity",
    "rouge_l_similarity",
)

TOUCH = (
    "touch_position_x",
    "touch_position_y",
    "touch_pressure",
    "total_touch_stroke_count",
    "touch_stroke_rate",
    "total_touch_count",
    "touch_event_rate",
    "touch_event_touch_stroke_ratio",
    "touch_pressure_change_rate",
    "high_pressure_touch_count",
    "touch_area",
    "touch_major_axis",
    "touch_minor_axis",
    "touch_area_change_rate",
    "touch_pressure_area_correlation",
    "first_touch_latency",
    "first_touch_duration",
    "tap_ratio",
    "swipe_ratio",
    "long_press_ratio",
    "swipe_velocity",
    "swipe_velocity_x",
    "swipe_velocity_y",
    "swipe_acceleration",
    "swipe_acceleration_x",
    "swipe_acceleration_y",
    "swipe_jerk",
    "swipe_jerk_x",
    "swipe_jerk_y",
    "swipe_direction",
    "swipe_angular_velocity",
    "high_velocity_touch_count",
    "swipe_path_length",
    "swipe_displacement",
    "swipe_path_curvature",
    "range_based_swipe_dispersion",
    "rms_based_swipe_dispersion",
    "bbox_area_based_swipe_dispersion",
    "swipe_direction_change_count",
    "range_based_swipe_endpoint_dispersion",
    "rms_based_swipe_endpoint_dispersion",
    "bbox_area_based_swipe_endpoint_dispersion",
    "swipe_bbox_width",
    "swipe_bbox_height",
    "swipe_bbox_area",
    "swipe_bbox_aspect_ratio",
    "horizontal_swipe_rate",
    "vertical_swipe_rate",
    "touch_area_slope",
    "touch_convex_hull_area",
    "touch_convex_hull_perimeter",
    "swipe_path_fractal_dimension",
    "touch_hold_duration",
    "tap_duration",
    "swipe_duration",
    "long_press_duration",
    "inter_touch_interval",
    "active_touch_time",
    "touch_stroke_pressure_slope",
    "inter_tap_interval",
    "inter_swipe_interval",
    "inter_long_press_interval",
    "tap_pressure",
    "swipe_pressure",
    "long_press_pressure",
    "touch_entropy",
    "edge_touch_ratio",
    "left_half_touch_ratio",
    "right_half_touch_ratio",
    "top_half_touch_ratio",
    "bottom_half_touch_ratio",
    "central_touch_ratio",
    "touch_offset_to_screen_center",
    "central_bias",
    "range_based_touch_dispersion",
    "rms_based_touch_dispersion",
    "bbox_area_based_touch_dispersion",
    "touch_covariance",
    "velocity_rhythm_rate",
    "velocity_rhythm_spectral_entropy",
    "velocity_rhythm_regularity",
    "acceleration_rhythm_rate",
    "acceleration_rhythm_spectral_entropy",
    "acceleration_rhythm_regularity",
)

VOICE = (
    "total_speech_time",
    "speech_ratio",
    "total_nonspeech_time",
    "nonspeech_ratio",
    "speech_velocity",
    "pause_duration",
    "pause_ratio",
    "pause_rate",
    "utterance_duration",
    "utterance_ratio",
    "utterance_rate",
    "utterance_pause_ratio",
    "loudness_level",
    "loudness_range",
    "loudness_slope",
    "pitch_level_f0",
    "pitch_variability",
    "pitch_range",
    "pitch_tremor_extent",
    "pitch_tremor_rate",
    "voiced_ratio",
    "unvoiced_ratio",
    "voicing_breaks_rate",
    "envelope_rhythm_rate",
    "envelope_rhythm_spectral_entropy",
    "envelope_rhythm_regularity",
    "amplitude_tremor_extent",
    "amplitude_tremor_rate",
    "dynamic_time_warping_similarity",
    "frequency_domain_similarity",
    "rouge_l_similarity",
)

INDICATORS = {"eye-tracking": EYE, "keyboard": KEYBOARD, "touch": TOUCH, "voice": VOICE}


def columns(modality: str) -> list[str]:
    """The modality's result columns: every indicator with mean, std, min and max."""
    return [f"{n}_{s}" for n in INDICATORS[modality] for s in STATS]


def slug(display: str) -> str:
    """Column base of a display name: lower case, runs of other characters as one underscore."""
    return re.sub(r"[^a-z0-9]+", "_", display.lower().replace("(f0)", "f0")).strip("_")
