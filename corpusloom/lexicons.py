"""Word lists and patterns of the rules, all of them parameters of the operators that use them.

Fixed values: results depend on them. Patterns are written so that Java, RE2 and Python read them alike.
"""

KEYWORDS = (
    "军事", "军队", "军人", "军兵种", "国防", "武装", "战争", "战役", "战斗", "作战", "战场", "战术", "战略", "训练", "演习", "兵力", "部队", "装备", "武器", "导弹", "舰艇", "飞机", "雷达", "火炮", "弹药", "后勤", "指挥", "情报", "侦察", "防空",
    "海军", "陆军", "空军", "火箭军", "联合作战", "国家安全", "安全形势", "边防", "维和", "反恐", "DARPA", "NATO", "北约",
)
TITLE_WEIGHTS = {
    "军事": 10, "军队": 9, "军人": 7, "军官": 7, "士兵": 7, "军衔": 8, "国防": 10, "战争": 9, "战役": 9, "战斗": 8, "作战": 9, "战术": 9, "战略": 8, "兵役": 8, "征兵": 8, "武器": 8, "装备": 7, "导弹": 8, "火炮": 8, "坦克": 8, "军舰": 8, "舰艇": 8,
    "航空母舰": 9, "战斗机": 9, "轰炸机": 8, "无人机": 7, "雷达": 7, "陆军": 9, "海军": 9, "空军": 9, "火箭军": 9, "宪兵": 7, "特种部队": 9, "边防": 7, "防空": 8, "后勤": 6, "参谋": 6, "情报": 6,
}
BODY_WEIGHTS = {
    "军事": 4, "军队": 4, "军人": 3, "国防": 4, "战争": 4, "战役": 4, "战斗": 3, "作战": 4, "战术": 4, "战略": 3, "训练": 2, "演习": 3, "兵力": 3, "部队": 4, "武装力量": 5, "武器": 4, "装备": 3, "导弹": 4, "舰艇": 4, "军舰": 4, "坦克": 4, "火炮": 4,
    "弹药": 3, "飞机": 2, "战斗机": 4, "雷达": 3, "指挥": 3, "参谋": 3, "情报": 3, "侦察": 3, "防空": 3, "陆军": 4, "海军": 4, "空军": 4, "火箭军": 4, "特种部队": 4, "军衔": 4, "兵役": 4, "军校": 3, "军事史": 5, "军事理论": 5, "联合国维和": 4,
    "北约": 3, "NATO": 3, "DARPA": 3,
}
EXCLUDED_TITLES = r"(?i)列表|消歧义|模板:|分类:|文件:|category:|template:|file:"
PAGE_RISKS = (r"(制作|制造|制备).{0,10}(炸药|爆炸物|雷管|燃烧瓶)", r"(炸药|爆炸物|雷管|毒剂).{0,10}(配方|合成|教程)", r"(规避|绕过).{0,10}(监控|侦察|安检|检测)")
CHUNK_RISKS = (
    r"制作.{0,8}(炸药|爆炸物|雷管|燃烧瓶)", r"(炸药|爆炸物|雷管|毒剂).{0,8}(配方|制备|合成|制作)", r"(绕过|规避).{0,8}(监控|安检|侦察|检测)", r"(暗杀|投毒|破坏).{0,12}(步骤|流程|方法|教程)",
)
#: On the text as a whole, white space at its ends aside, and anywhere in it.
BOILERPLATE_WHOLE = (r"(?i)^(目录|目\s*录|contents)$", r"(?i)^(参考文献|references|bibliography)$")
BOILERPLATE_PART = (r"(?i)版权所有|copyright|免责声明", r"扫一扫|关注公众号|点击下载|返回顶部", r"第\s*\d+\s*页\s*/\s*共\s*\d+\s*页")
REFERENCE_HEADING = r"(?i)(^|\n)\s*(参考文献|主要参考文献|参考资料|references|bibliography|works cited)\s*[:：]?\s*(\n|$)"
REFERENCE_LINES = (
    r"^\s*(\[\s*\d+\s*\]|\d+\s*[.．、])\s*\S+", r"(?i)\bdoi\s*[:：]?\s*10\.\d{4,9}/", r"(?i)\[[jmncdrsp]\]", r"(?i)\b(et\s+al\.|ibid\.|vol\.|no\.|pp\.)\b", r"(?i)\b(issn|isbn)\b", r"(?i)https?://|www\.",
    r"\d{4}\s*[,，]\s*\d+\s*[(（]\s*\d+\s*[)）]\s*[:：]\s*\d+\s*[-－]\s*\d+", r"\d{4}\s*[,，]\s*\d+\s*[:：]\s*\d+\s*[-－]\s*\d+",
)
REFERENCE_CUT = r"(?i)^(参考文献|主要参考文献|references?|bibliography)\s*[:：]?$"
#: What any of the above must contain; saves looking at the lines of other texts.
REFERENCE_HINT = r"(?i)参考文献|references?|bibliography"
GARBLED_TOKENS = ("鈥", "銆", "鍥", "涓", "涔", "绋", "鐨", "戠", "嗗", "嬫", "槸", "", "€", "�")
GARBLED_SIGNS = "锛鍐鏂閲勬槸绋簨鐨瑙规垬艰粛浜軍€俓"
COMMON_SIGNS = "的一是在和了有中国军事军队战争国防装备人民"
WIKI_TAIL = r"(^|\n)##\s*(参考文献|參考文獻|注释|註釋|外部链接|外部連結|参见|參見|相关条目|相關條目)\.?\s*(\n|$)"
SENTENCE_ENDS = "。！？；!?;"
SECTION_WORDS = ("目录", "前言", "结束语", "附录", "思考题")
CHAPTER = r"^(第[一二三四五六七八九十百]+[章节]|[一二三四五六七八九十]+[、.])"
PAREN_NUMBER = r"^[（(][一二三四五六七八九十]+[）)]"
SPEAKERS = r"(记者|问|答|发言人|主持人|国防部新闻发言人|张晓刚|吴谦|蒋斌|谭克非|任国强|杨宇军)\s*[：:]"
MD_CHAPTER, MD_SECTION = r"^(第[一二三四五六七八九十百]+章|附录)\b", r"^第[一二三四五六七八九十百]+节\b"
MD_LEVELS = (r"^[一二三四五六七八九十]+[、 ]", PAREN_NUMBER, r"^\d+[.、 ]")
PDF_REFERENCES = r"(?i)^(参考文献|参\s*考\s*文\s*献|references?|参考资料|注释)\s*[:：]?$"
PDF_REFERENCES_INLINE = r"(?i)(参考\s*文\s*献|references?|参考资料|注释)\s*[:：]?"
PDF_AUTHOR = r"^作者简介\s*[:：]"
PDF_METADATA = r"^(摘\s*要|关键词|中图分类号|文献标识码|文章编号|DOI)\s*[:：]"
PDF_NOISE = (
    r"(?i)^(第\s*\d+\s*[卷期]|vol\.\s*\d+|no\.\s*\d+|国\s*防\s*科\s*技|national defense technology|\d{4}\s*年\s*第\s*\d+\s*期|总第\s*\d+\s*期|\d+)\s*$", r"NATIONAL DEFENSE TECHNOLOGY", r"(?i)vol\.\s*\d+,\s*no\.\s*\d+", r"^\d{4}\s*年\s*\d+\s*月$",
    r"^\d+\s+国防科技\s+\d{4}\s*年第\s*\d+\s*期.*$", r"^万方数据$", r"^[-–—_]{3,}$", r"^\d+\s+国防科技\s+\d{4}.*$", r"^第\s*\d+\s*页\s*/\s*共\s*\d+\s*页$",
)
CONTEXT_PHRASES = ("根据材料", "结合材料", "从材料中", "材料中", "文中提到", "上述内容", "结合上文", "从上文", "根据上文", "这段文字", "该材料")
QUESTION_TYPES = ("qa", "summary", "extraction", "classification", "comparison", "reasoning", "rewrite", "json_generation", "critique", "refusal", "drafting", "plan", "outline")
ANSWER_FORMATS = ("plain_text", "bullets", "table", "json")
DIFFICULTIES = ("easy", "medium", "hard")
RISK_LABELS = ("public_safe", "needs_caution", "refuse_or_exclude")
ISSUE_TYPES = ("none", "off_topic", "too_generic", "factual_risk", "unsafe", "over_refusal", "format_noise", "empty")
ACTIONS = ("keep", "rewrite", "drop")
#: Prefixes that are taken off a question.
CONTEXT_PREFIXES = (
    "根据材料：", "根据材料,", "根据材料，", "结合材料：", "结合材料,", "结合材料，", "根据上述材料：", "根据上述材料,", "根据上述材料，", "结合上文：", "结合上文,", "结合上文，",
    "从材料看：", "从材料看,", "从材料看，", "文中提到：", "文中提到,", "文中提到，", "请根据材料", "请结合材料",
)
#: The quality levels of scores to 2, 4, 6, 8 and 10.
LEVELS = ("不可用", "较差", "可用", "良好", "优秀")
#: The reasons of verdicts without a judge.
CHECK_REASONS = {
    "empty_question": "问题为空，无法进入答案生成阶段。", "depends_on_source_context": "问题依赖原始材料或上文，不能被模型独立回答。", "too_short": "问题过短，任务边界不清。", "pair_without_question": "问题为空，不能构成 SFT 训练样本。",
    "empty_answer": "答案为空，不能构成 SFT 训练样本。", "answer_depends_on_source_context": "答案依赖原始材料或上文，不适合作为独立 SFT 样本。", "answer_too_short": "答案过短，信息量不足，训练价值较低。",
}
#: Reasons of a plan made from types, and of a reply without a question.
FALLBACK_REASON, NO_QUESTION_REASON = "由推荐题型列表回退生成。", "模型未返回可用问题"
#: Names of sites at the end of titles, of one site and of several; titles that say nothing; dates in pages.
SITE_NAMES = ("中国军网", "解放军报", "军事", "首页")
MANY_SITE_NAMES = ("中国军网", "国防部", "军事", "人民网", "央视网", "新华网", "新华社", "中国新闻网")
GENERIC_TITLES = ("人民日报报系", "无标题文档", "要闻推荐\nWe Recommend", "要闻推荐 We Recommend")
PAGE_DATE = r"20\d{2}年\d{1,2}月\d{1,2}日(?:\s*\d{1,2}:\d{2})?|20\d{2}-\d{1,2}-\d{1,2}(?:\s+\d{1,2}:\d{2})?|20\d{2}/\d{1,2}/\d{1,2}(?:\s+\d{1,2}:\d{2})?"
