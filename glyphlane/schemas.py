"""Declared row types of the files the jobs read."""

from __future__ import annotations

TURN = "struct<from:string,value:string>"
# string-or-list fields arrive as JSON text and are normalised on read
SAMPLE = (f"image variant, images variant, video variant, videos variant, "
          f"conversations array<{TURN}>, num_tokens bigint")
PACKED_SAMPLE = (f"struct<image:variant,images:variant,video:variant,videos:variant,"
                 f"conversations:array<{TURN}>,num_tokens:bigint>")
AGENT_LOG = "messages string, image_payload_id string, total_tokens string"
PREDICTION = "struct<gen:string,gen_raw:string>"
COCO = (
    "images array<struct<id:bigint,file_name:string,height:bigint,width:bigint>>, "
    "annotations array<struct<id:bigint,image_id:bigint,category_id:bigint,bbox:array<double>,area:double,iscrowd:int>>, "
    "categories array<struct<id:bigint,name:string>>")
DATASET_CONFIG = "name string, classes array<string>, data_root string, ann_file string, img_prefix string"
CAMERA = "struct<fx:double,fy:double,cx:double,cy:double>"
CODE_PROBLEM = "question string, images array<string>, starter_code string, input_output string, problem_id string"
